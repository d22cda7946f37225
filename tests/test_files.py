"""Hand-written file cases (FIXTURES §4), each in a fresh scratch folder."""

import json
import os

from pyspark.sql import functions as F

from chatloom.operators.normalize import normalize_moss
from chatloom.sources import files as FS


def write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, encoding="utf-8", newline="") as f:
        f.write(text)


def test_nested_dirs_upper_txt_crlf_and_csv(spark, tmpdir_fresh):
    root = tmpdir_fresh
    write(f"{root}/a/b/one.TXT", "line1\r\nline2\rline3\r\n")
    write(f"{root}/two.txt", "plain")
    write(f"{root}/c/skip.csv", "a,b\n1,2\n")
    res = FS.scan_directory(spark, root)
    texts = sorted(r.text for r in res.samples.collect())
    assert texts == ["line1\nline2\nline3\n", "plain"]
    st = {os.path.basename(r.file_path): (r.format, r.status) for r in res.files.collect()}
    assert st["skip.csv"] == ("unknown", "skipped")
    assert st["one.TXT"] == ("txt", "loaded")
    s = res.samples.where(F.col("text") == "plain").first()
    assert s.type == "pretrain" and s.source.endswith("two.txt")


def test_jsonl_blank_and_malformed_lines(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/d.jsonl"
    lines = ['{"instruction": "a", "output": "b"}', "", "   ", "{bad json", '{"instruction": "c", "output": "d"}']
    write(p, "\n".join(lines) + "\n")
    r = FS.read_jsonl(spark, p).orderBy("ordinal").collect()
    assert [(x.ordinal, x.line, x.valid) for x in r] == [(0, 1, True), (1, 4, False), (2, 5, True)]
    res = FS.scan_directory(spark, tmpdir_fresh)
    assert sorted(x.source for x in res.samples.collect()) == ["d.jsonl:0", "d.jsonl:2"]
    q = res.quarantine.collect()
    assert [(x.ordinal, x.reason) for x in q] == [(1, "bad_json")]


def test_ordinals_exact_across_file_splits(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/big.jsonl"
    rows = []
    for i in range(4000):
        rows.append(json.dumps({"i": i, "pad": "x" * 50}))
        if i % 7 == 0:
            rows.append("")
    write(p, "\n".join(rows) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        r = FS.read_jsonl(spark, p)
        n_parts = spark.read.text(p).select("_metadata.file_block_start").distinct().count()
        got = r.select("ordinal", F.get_json_object("value", "$.i").cast("long").alias("i")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert n_parts > 4
    assert all(x.ordinal == x.i for x in got) and len(got) == 4000


def test_trailing_garbage_only_strict(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/g.jsonl"
    write(p, '{"a":1}{\n{"b":2}\n')
    lenient = [x.valid for x in FS.read_jsonl(spark, p).orderBy("ordinal").collect()]
    strict = [x.valid for x in FS.read_jsonl(spark, p, strict=True).orderBy("ordinal").collect()]
    assert lenient == [True, True] and strict == [False, True]


def test_pretty_and_one_line_arrays_and_jsonl_in_json(spark, tmpdir_fresh):
    items = [{"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]},
             {"conversations": [{"from": "user", "value": "q"}, {"from": "bot", "value": "a"}]}]
    write(f"{tmpdir_fresh}/pretty.json", json.dumps(items, indent=2))
    write(f"{tmpdir_fresh}/one.json", json.dumps(items))
    write(f"{tmpdir_fresh}/lines.json", "\n".join(json.dumps(x) for x in items) + "\n")
    write(f"{tmpdir_fresh}/obj.json", json.dumps(items[0], indent=2))
    res = FS.scan_directory(spark, tmpdir_fresh)
    got = sorted(x.source for x in res.samples.collect())
    assert got == ["lines.json:0", "lines.json:1", "obj.json:0", "one.json:0", "one.json:1",
                   "pretty.json:0", "pretty.json:1"]
    assert {x.format for x in res.samples.collect()} == {"sharegpt"}


def test_scalar_json_document(spark, tmpdir_fresh):
    write(f"{tmpdir_fresh}/s.json", "42")
    r = FS.read_json_document(spark, f"{tmpdir_fresh}/s.json").collect()
    assert [json.loads(x.value) for x in r] == [{"_data": 42}]


def _records(spark, items):
    return spark.createDataFrame([("f.jsonl", i, json.dumps(x)) for i, x in enumerate(items)],
                                 "file_path string, ordinal long, value string")


def test_moss_turn_order_and_defaults(spark):
    conv = {f"turn_{i}": {"Human": f"h{i}", "MOSS": f"m{i}"} for i in range(1, 13)}
    recs = _records(spark, [{"conversation": conv}])
    num = normalize_moss(recs).samples.first()
    lex = normalize_moss(recs, turn_order="lexical").samples.first()
    assert [t.content for t in num.dialog][:6] == ["h1", "m1", "h2", "m2", "h3", "m3"]
    assert [t.content for t in lex.dialog][:4] == ["h1", "m1", "h10", "m10"]
    assert num.turns == 12 and num.source == "f.jsonl:unknown" and num.category == "unknown"


def test_sharegpt_unknown_role_and_no_assistant(spark):
    from chatloom.operators.normalize import normalize_sharegpt
    recs = _records(spark, [
        {"system": "sys", "conversations": [{"from": "human", "value": "q"}, {"from": "tool", "value": "x"},
                                              {"from": "gpt", "value": "a"}, {"from": "gpt"}]},
        {"conversations": [{"from": "human", "value": "only"}]},
        {"system": "", "conversations": [{"value": "no from"}, {"from": "assistant", "value": "ok"}]},
    ])
    n = normalize_sharegpt(recs)
    s = {x.ordinal: x for x in n.samples.collect()}
    assert [(t.role, t.content) for t in s[0].dialog] == [("system", "sys"), ("user", "q"), ("assistant", "a"),
                                                         ("assistant", "")]
    assert s[0].turns == 2
    assert [(t.role, t.content) for t in s[2].dialog] == [("assistant", "ok")]
    assert [(x.ordinal, x.reason) for x in n.quarantine.collect()] == [(1, "no_assistant")]


def test_alpaca_input_output_cases(spark):
    from chatloom.operators.normalize import normalize_alpaca
    recs = _records(spark, [
        {"instruction": "do", "input": "", "output": "done"},
        {"instruction": "do", "input": "this", "output": ""},
        {"instruction": "do", "output": None},
        {"instruction": "do"},
        {"system": "be nice", "instruction": "x", "output": "y"},
    ])
    n = normalize_alpaca(recs)
    s = {x.ordinal: [(t.role, t.content) for t in x.dialog] for x in n.samples.collect()}
    assert s[0] == [("user", "do"), ("assistant", "done")]
    assert s[1] == [("user", "do\nthis"), ("assistant", "")]
    assert s[4][0] == ("system", "be nice")
    assert sorted((x.ordinal, x.reason) for x in n.quarantine.collect()) == [(2, "null_content"), (3, "missing_key")]


def test_missing_path_is_an_error(spark, tmpdir_fresh):
    import pytest
    with pytest.raises(Exception):
        FS.scan_directory(spark, f"{tmpdir_fresh}/does-not-exist").samples.count()


def test_register_format_extension(spark, tmpdir_fresh):
    from chatloom.operators import normalize as N
    from chatloom.sources.tables import conform

    def norm_qa(records):
        q = F.get_json_object("value", "$.q")
        a = F.get_json_object("value", "$.a")
        s = records.select("file_path", "ordinal", F.lit("dialog").alias("kind"),
                           F.array(F.struct(F.lit("user").alias("role"), q.alias("content")),
                                   F.struct(F.lit("assistant").alias("role"), a.alias("content"))).alias("dialog"),
                           F.lit("qa").alias("format"), F.lit("sft").alias("type"))
        return N.Normalized(conform(s),
                            records.limit(0).select("file_path", "ordinal", F.col("value").alias("raw"),
                                                    F.lit("x").alias("reason")))
    N.register_format("qa", lambda k: N._has(k, "q"), norm_qa)
    try:
        write(f"{tmpdir_fresh}/x.jsonl", '{"q": "1+1?", "a": "2"}\n')
        res = FS.scan_directory(spark, tmpdir_fresh)
        assert [x.format for x in res.samples.collect()] == ["qa"]
    finally:
        N._REGISTRY.pop("qa")
