"""Documents read in splits: the same records as from the whole text, wherever the splits fall."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from chatloom.sources import files as FS
from chatloom.sources import json_split as J


def records(text):
    return list(J.text_records(text))


def test_records_of_a_text():
    assert records('[1, {"a": [2]} ,"x"]') == [(0, None, "1"), (1, None, '{"a": [2]}'), (2, None, '"x"')] and records(" [ ] ") == []
    assert records("") == [] and records(" \n ") == [] and records("[1,]") == [(0, None, "1"), (1, None, "")]
    assert records('{"a":\r\n 1}\n') == [(0, None, '{"a":\r\n 1}')] and records("7") == [(0, None, '{"_data":7}')]
    assert records("[1, 2") == [(0, None, "[1, 2")] and records("nope") == [(0, None, "nope")]
    assert records('{"a":1}\n\n{"b":2}\r\nx,y') == [(0, 1, '{"a":1}'), (1, 3, '{"b":2}'), (2, 4, "x,y")]
    assert records('[1]\n[2]') == [(0, 1, "[1]"), (1, 2, "[2]")]
    # brackets, commas, quotes and backslashes inside strings are text
    odd = [{"a": 'x],[ "q" \\'}, "\\", '\\"', ["]", {"}": ","}], "é,日本", -1.5, None]
    for indent in (None, 1):
        assert [json.loads(v) for _, _, v in records(json.dumps(odd, indent=indent, ensure_ascii=False))] == odd


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 4 else 4)
    if kind < 3:
        return "".join(rng.choices(['"', "\\", ",", "[", "]", "{", "}", "a", "é", "\n", " ", "日", "\r"], k=rng.randrange(12)))
    if kind == 3:
        return rng.choice([0, -1.5, None, True, 1e9])
    if kind < 6:
        return {f"k{i}": value(rng, depth + 1) for i in range(rng.randrange(5))}
    return [value(rng, depth + 1) for _ in range(rng.randrange(6))]


def document(rng, kind):
    items = [value(rng) for _ in range(rng.randrange(40))]
    pack = lambda x: json.dumps(x, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5)
    if kind == "array":
        return rng.choice(["", " \n"]) + pack(items) + rng.choice(["", "\n", " \r\n"])
    if kind == "value":
        return pack({"a": items, "b": value(rng)}) + rng.choice(["", "\n"])
    lines = [json.dumps(x) for x in items] + ["", "  ", "{bad, line", "[1", "]", "x,y", '"open']
    rng.shuffle(lines)
    if kind == "lines":
        return rng.choice(["\n", "\r\n"]).join(lines) + rng.choice(["", "\n", "\n\n"])
    text = pack(items)  # broken: cut off, an extra bracket, two documents
    return rng.choice([text[:len(text) * 2 // 3], text + "]", "[" + text, text + pack(items), "[1}", "{]", text + " ,", "42", ",", '"a, b"'])


@pytest.mark.parametrize("split, n_files", [("40b", 12), ("400b", 60), ("64k", 60)])
def test_splits_give_the_records_of_the_whole_text(spark, tmpdir_fresh, split, n_files):
    rng = random.Random(12)
    want = {}
    for i in range(n_files):
        text = document(rng, ("array", "value", "lines", "broken")[i % 4])
        name = f"d{i:02d}.json"
        with open(f"{tmpdir_fresh}/{name}", "w", encoding="utf-8", newline="") as f:
            f.write(text)
        want[name] = records(text)
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        pieces = J.scan_pieces(spark, tmpdir_fresh, FS.GLOBS["json"])
        n_splits = pieces.select("file_path", "block").distinct().count()
        got = {}
        for r in J.document_items(pieces).collect():
            got.setdefault(os.path.basename(r.file_path), []).append((r.ordinal, r.line, r.value))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert n_splits > {"40b": 10 * n_files, "400b": n_files}.get(split, 0)
    for name, rows in want.items():
        assert sorted(got.get(name, [])) == rows, name


def test_one_line_array_in_many_tasks(spark, tmpdir_fresh):
    items = [{"instruction": f"i{i}", "input": "a, b", "output": "x, " * (200_000 if i == 700 else 300)} for i in range(2000)]
    with open(f"{tmpdir_fresh}/one.json", "w") as f:
        json.dump(items, f)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        rec = FS.read_json_document(spark, f"{tmpdir_fresh}/one.json")
        rows = rec.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert len({r.task for r in rows}) > 8
    assert [json.loads(r.value) for r in sorted(rows, key=lambda r: r.ordinal)] == items and all(r.valid for r in rows)
