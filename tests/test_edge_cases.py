"""Cases where size, ties, odd values or odd inputs once changed a result."""

import json
import math
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chatloom.operators import sampling as H
from chatloom.operators import trainlog as G
from chatloom.operators.samples import accumulate_load
from chatloom.operators.tokenize import encode_turns
from chatloom.operators.vocab import collect_lookup, turn_table_vocab
from chatloom.operators.windows import turn_table_windows
from chatloom.plans import queries_train as Q
from chatloom.sources import files as FS
from chatloom.sources.tables import resolve_text_column, text_samples
from chatloom.streaming.incremental import incremental_load, read_samples, skipped_files

TURNS = "conv_id long, turn long, role string, text string"


def test_contexts_of_a_dialog_with_more_than_4096_windows(spark, tmpdir_fresh):
    long = "abcdefghij" * 54_000
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", long), (1, 0, "user", "q"), (1, 1, "assistant", "short answer")]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmpdir_fresh}/conversations.parquet")
    n = turn_table_windows(spark.createDataFrame(rows, TURNS))[0].count()
    assert n > 4200
    drawn = Q.q_draw_token(spark, tmpdir_fresh).collect()
    assert len(drawn) == n == len({(r.sample_id, r.window_no) for r in drawn})
    assert all(len(r.drawn.split(",")) == 256 for r in drawn)


def test_cross_entropy_is_stable_and_null_without_a_logit(spark):
    lg = spark.createDataFrame([("a", 1, 1000.0), ("a", 2, 999.0), ("b", 1, -5.0)], "ctx_id string, token_id int, logit double")
    tg = spark.createDataFrame([("a", 2), ("b", 7), ("c", 1)], "ctx_id string, token_id int")
    got = {r.ctx_id: r.ce for r in H.cross_entropy(lg, tg).collect()}
    assert got["a"] == pytest.approx(1 + math.log(1 + math.exp(-1))) and got["b"] is None and got["c"] is None


def test_recent_sets_with_gaps(spark):
    rec = spark.createDataFrame([("a", 1000 * i, i) for i in range(30)], "ctx_id string, pos int, token_id int")
    assert sorted(H.recent_sets(rec).first().recent_ids) == list(range(20, 30))


@pytest.mark.parametrize("bucket", [100, 128, 4096])
def test_rolling_means_equal_the_plain_frame(spark, bucket):
    rng = random.Random(bucket)
    odd = {0: 45.0, 150: 800.0, 320: float("nan"), 321: None, 450: float("inf")}
    rows = [(r, e, s * (1 if r else 3), odd.get(s, rng.random() * 5), None if rng.random() < 0.05 else rng.random(), rng.random())
            for r in (0, 1) for e in (0, 1) for s in range(700)]
    log = spark.createDataFrame(rows, "run_id long, epoch int, step long, loss double, grad_norm double, mask_mean double")
    w = Window.partitionBy("run_id", "epoch").orderBy("step").rowsBetween(-99, 0)
    plain = log.withColumn("ppl", F.exp("loss")).select(
        "run_id", "epoch", "step", *[F.avg(c).over(w).alias(a) for c, a in
                                     (("loss", "avg_loss"), ("grad_norm", "avg_grad"), ("mask_mean", "avg_mask"), ("ppl", "avg_ppl"))]) \
        .where("step % 25 = 0")
    cols = ["avg_loss", "avg_grad", "avg_mask", "avg_ppl"]

    def keyed(df):
        return {(r.run_id, r.epoch, r.step): [r[c] for c in cols] for r in df.collect()}
    want, got = keyed(plain), keyed(G.rolling_metrics(log, bucket=bucket))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12, nan_ok=True), k
    assert got[1, 0, 300][3] < 200  # the losses of 45 and 800 are forgotten


def _windows(w):
    return sorted((r.sample_id, r.window_no, tuple(r.input_ids), tuple(r.loss_mask)) for r in w.collect())


def test_ties_give_the_same_windows_on_both_routes(spark):
    rng = random.Random(1)
    rows = [(0, 5, rng.choice(["user", "assistant", "system", None]), rng.choice(["b", "a", "c", None]) if rng.random() < 0.9 else "x" * 300)
            for _ in range(21)] + [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    rows = [(i, t, r, x if x is not None else "n") for i, t, r, x in rows]
    turns = spark.createDataFrame(rows, TURNS)
    assert _windows(turn_table_windows(turns, max_turns=1)[0]) == _windows(turn_table_windows(turns, max_turns=100)[0])


@pytest.mark.parametrize("max_turns", [1, 100])
def test_string_dialog_ids(spark, max_turns):
    rows = [("k-1", 0, "user", "hello"), ("k-1", 1, "assistant", "world " * 80), ("é/2", 0, "user", "no answer")]
    turns = spark.createDataFrame(rows, TURNS.replace("conv_id long", "conv_id string"))
    numbers = spark.createDataFrame([({"k-1": 1, "é/2": 2}[a], *b) for a, *b in rows], TURNS)
    got, want = (_windows(turn_table_windows(t, max_turns=max_turns, mask_scope="sample")[0]) for t in (turns, numbers))
    assert [g[1:] for g in got] == [x[1:] for x in want] and {g[0] for g in got} == {"conversations:k-1"}
    v = collect_lookup(turn_table_vocab(turns))
    assert {r.sample_id for r in encode_turns(turns, v).collect()} == {"conversations:k-1"}


def test_large_json_array_and_bad_first_line(spark, tmpdir_fresh):
    big = "x" * (8 << 20)
    with open(f"{tmpdir_fresh}/big.json", "w") as f:
        json.dump([{"instruction": f"i{i}", "input": "", "output": big} for i in range(20)], f)
    with open(f"{tmpdir_fresh}/bad.json", "w") as f:
        f.write('{"instruction": broken\n\n{"instruction": "a", "output": "b"}\n{"instruction": "c", "output": "d"}\n')
    with open(f"{tmpdir_fresh}/junk.json", "w") as f:
        f.write("{never\nvalid]\n")
    assert os.path.getsize(f"{tmpdir_fresh}/big.json") > 160_000_000
    res = FS.scan_directory(spark, tmpdir_fresh)
    got = {os.path.basename(r.f): r.n for r in res.samples.groupBy(F.col("file_path").alias("f")).agg(F.count("*").alias("n")).collect()}
    assert got == {"big.json": 20, "bad.json": 2}
    q = sorted((os.path.basename(r.file_path), r.ordinal, r.reason) for r in res.quarantine.collect())
    assert q == [("bad.json", 0, "bad_json"), ("junk.json", 0, "bad_json"), ("junk.json", 1, "bad_json")]
    res.release()


def test_stream_routes_by_suffix_like_batch(spark, tmpdir_fresh):
    inp, out, ck = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/ck"
    os.makedirs(f"{inp}/sub")
    one = {"instruction": "i", "input": "", "output": "o"}
    for name, text in {"story.txt": "Once\r\nupon {a} time\n\nend", "sub/B.TXT": "", "a.jsonl": json.dumps(one) + "\n", "b.json": json.dumps([one, one]),
                       "t.csv": "a,b\n1,2\n"}.items():
        with open(f"{inp}/{name}", "w", newline="") as f:
            f.write(text)
    incremental_load(spark, inp, out, ck).awaitTermination()
    cols = ["kind", "text", "dialog", "file_path", "type", "format"]

    def norm(df):
        return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())
    assert norm(read_samples(spark, out)) == norm(FS.scan_directory(spark, inp).samples)
    assert spark.read.parquet(f"{out}/quarantine").count() == 0
    assert [os.path.basename(r.file_path) for r in skipped_files(spark, inp).collect()] == ["t.csv"]


def test_table_samples_have_unique_ids_and_keep_nulls(spark, tmpdir_fresh):
    rows = [("same", None, 1)] * 50 + [("", "x", 2), (None, "x", 3), ("other", "y", 4)]
    spark.createDataFrame(rows, "text string, note string, k long").repartition(5).write.parquet(f"{tmpdir_fresh}/t")
    got = resolve_text_column(spark.read.parquet(f"{tmpdir_fresh}/t"), "text", "t").collect()
    assert len(got) == 51 == len({r.sample_id for r in got}) and sorted(r.ordinal for r in got) == list(range(51))
    assert {r.source for r in got} == {f"hf://t/train:{i}" for i in range(51)}
    assert json.loads(next(r.metadata for r in got if r.text == "same")) == {"note": None, "k": 1}


def test_load_that_runs_twice_counts_once(spark, tmpdir_fresh):
    s = text_samples(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"))
    path = f"{tmpdir_fresh}/loads"
    for n in (0, 1, 1):
        report = accumulate_load(s, path, n)
    assert sorted((r.load_no, r.added, r.total) for r in report.collect()) == [(0, 2, 2), (1, 2, 4)]


def test_moss_turns_sort_by_numbers_of_any_length(spark):
    import json

    from chatloom.operators.normalize import normalize_moss
    big = "9" * 25
    names = ["turn_x", f"turn_1{big}", "turn_10", "turn_0", "turn_007", f"turn_{big}", "turn_2", "turn_00"]
    conv = {k: {"Human": k, "MOSS": "a"} for k in names}
    rec = spark.createDataFrame([("f", 0, json.dumps({"conversation": conv}))], "file_path string, ordinal long, value string")
    rec = rec.selectExpr("*", "try_parse_json(value) AS _v")
    dialog = normalize_moss(rec).samples.first().dialog
    want = ["turn_0", "turn_00", "turn_2", "turn_007", "turn_10", f"turn_{big}", f"turn_1{big}", "turn_x"]
    assert [t.content for t in dialog if t.role == "user"] == sorted(want[:2]) + want[2:]
