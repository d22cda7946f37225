"""Operator edge semantics on small hand-made frames."""

import math

from pyspark.sql import functions as F

from chatloom.operators import profile as P
from chatloom.operators import sampling as H
from chatloom.operators import trainlog as G
from chatloom.operators.samples import accumulate_load, clear_samples
from chatloom.operators.tokenize import extract_response, render_prompt
from chatloom.sources.tables import resolve_text_column, text_samples


def logits(spark, rows):
    return spark.createDataFrame(rows, "ctx_id long, token_id int, logit double")


def test_top_k_keeps_ties(spark):
    df = logits(spark, [(1, 0, 3.0), (1, 1, 2.0), (1, 2, 2.0), (1, 3, 1.0)])
    assert sorted(r.token_id for r in H.top_k_filter(df, 2).collect()) == [0, 1, 2]
    assert H.top_k_filter(df, 0).count() == 4


def test_nucleus_mass_before(spark):
    # probs ~ [0.665, 0.245, 0.090] -> mass before third = 0.910 > 0.9: dropped; the first is always kept
    df = logits(spark, [(1, 0, 2.0), (1, 1, 1.0), (1, 2, 0.0)])
    assert sorted(r.token_id for r in H.nucleus_filter(df, 0.9).collect()) == [0, 1]
    assert [r.token_id for r in H.nucleus_filter(df, 0.01).collect()] == [0]


def test_repetition_penalty_raw_divide_last_n(spark):
    df = logits(spark, [(1, 0, 2.0), (1, 1, -2.0), (1, 2, 1.0)])
    recent = spark.createDataFrame([(1, p, t) for p, t in enumerate([2] + [0] * 5 + [1] * 5)],
                                   "ctx_id long, pos int, token_id int")
    got = {r.token_id: r.logit for r in H.repetition_penalty(df, recent, 2.0).collect()}
    assert got == {0: 1.0, 1: -1.0, 2: 1.0}      # token 2 is older than the last 10
    assert H.repetition_penalty(df, recent, 1.0).count() == 3


def test_softmax_draw_and_cross_entropy(spark):
    df = logits(spark, [(c, t, float(t)) for c in range(50) for t in range(4)])
    probs = H.softmax(df)
    s = probs.groupBy("ctx_id").agg(F.sum("prob").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-12 for r in s)
    drawn = H.draw_token(probs, seed=3).collect()
    assert len(drawn) == 50 and len({r.ctx_id for r in drawn}) == 50
    ce = H.cross_entropy(df, spark.createDataFrame([(0, 3)], "ctx_id long, token_id int")).first().ce
    lse = math.log(sum(math.exp(x) for x in range(4)))
    assert abs(ce - (lse - 3)) < 1e-12


def test_extract_response_strip_and_markers(spark):
    rows = [("<user>hi<assistant>　 answer  <eos>",), ("no marker  ",), ("<assistant>a<assistant> b ",)]
    df = spark.createDataFrame(rows, "s string").select(extract_response("s").alias("r"))
    assert [r.r for r in df.collect()] == ["answer", "no marker  ", "b"]
    p = spark.createDataFrame([("x",)], "p string").select(render_prompt("p").alias("q")).first().q
    assert p == "<user>x<assistant>"


def test_resolve_text_column_rules(spark):
    df = spark.createDataFrame([("", "c1", 1), (None, "c2", 2), ("t3", "c3", 3)], "text string, content string, k int")
    got = resolve_text_column(df, "text").collect()
    assert [r.text for r in got] == ["t3"]                         # empty preferred value: dropped
    assert "content" in got[0].metadata and '"text"' not in got[0].metadata
    df2 = spark.createDataFrame([("c", 1)], "content string, k int")
    assert resolve_text_column(df2, "body").first().text == "c"     # first present candidate
    long = "y" * 60
    df3 = spark.createDataFrame([("short", long), ("s", "tiny")], "a string, b string")
    assert [r.text for r in resolve_text_column(df3, "body").collect()] == [long]


def test_best_and_checkpoint_schedule(spark):
    losses = [5.0, 4.0, 4.5, 3.0] + [2.995] * 12
    ep = spark.createDataFrame([(0, i, x) for i, x in enumerate(losses)], "run_id long, epoch int, epoch_loss double")
    assert [r.epoch for r in G.best_epochs(ep).orderBy("epoch").collect()] == [0, 1, 3, 4]
    stop = G.early_stop_epoch(ep).first()
    assert (stop.stop_epoch, stop.last_epoch) == (13, 13)          # 3.0 -> 2.995 is not a significant drop
    kinds = {(r.epoch, r.kind) for r in G.checkpoint_schedule(ep).collect()}
    assert {(4, "periodic"), (9, "periodic"), (13, "early_stop"), (13, "final"), (0, "best")} <= kinds
    assert not any(e > 13 for e, _ in kinds)


def test_preview_and_lifecycle(spark, tmpdir_fresh):
    docs = spark.createDataFrame([(1, "a" * 150), (0, "short")], "doc_id long, text string")
    s = text_samples(docs)
    pv = P.sample_preview(s).first()
    assert (pv.total, pv.preview) == (2, "short")
    s2 = text_samples(spark.createDataFrame([(0, "b" * 150)], "doc_id long, text string"), source_name="x")
    assert P.sample_preview(s2).first().preview == "b" * 100 + "..."
    path = f"{tmpdir_fresh}/samples"
    accumulate_load(s, path, 1)
    rep = [(r.load_no, r.added, r.total) for r in accumulate_load(s2, path, 2).orderBy("load_no").collect()]
    assert rep == [(1, 2, 2), (2, 1, 3)]
    assert clear_samples(spark, path).count() == 0


def test_token_count_matches_scan(spark):
    from chatloom.functions.kernels import CharLookup
    from chatloom.functions.text import token_count
    lk = CharLookup(list("ab<>"), [7, 8, 9, 10])
    rows = ["", "ab", "<user>", "a<assistant>b<eos><eos>", "<<user>>", "<use<user>r>", "😀<sep>中<pad"]
    df = spark.createDataFrame([(r,) for r in rows] + [(None,)], "t string")
    got = [r.n for r in df.select(token_count("t").alias("n")).collect()]
    assert got == [len(lk.encode(r)) for r in rows] + [0]


def test_require_content(spark):
    import pytest
    from chatloom.schema import SAMPLES
    with pytest.raises(ValueError):
        P.require_content(spark.createDataFrame([], SAMPLES))
    docs = text_samples(spark.createDataFrame([(1, "x")], "doc_id long, text string"))
    assert P.require_content(docs) == (0, 1)
