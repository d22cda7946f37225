"""Sampling at every position of the windows against the step operators over a logits table."""

import random

import pytest
from pyspark.sql import functions as F

from chatloom.operators import bigram as BG
from chatloom.operators import sampling as H

WINDOWS = "sample_id string, window_no int, input_ids array<int>, target_ids array<int>, loss_mask array<tinyint>"
LOGITS = "prev_id int, token_id int, logit double"


def windows(spark, rng, n=6, size=24, vocab=12):
    rows = []
    for i in range(n):
        ids = [rng.choice([rng.randrange(vocab), rng.randrange(3)]) for _ in range(size + 1)]
        rows.append((f"s{i % 3}", i // 3, ids[:-1], ids[1:], [1] * size))
    return spark.createDataFrame(rows, WINDOWS), rows


def table(spark, rng, vocab=12, low=0.0):
    rows = [(p, t, round(rng.uniform(low, 3), 1)) for p in range(vocab) for t in range(vocab) if p != 5 and rng.random() < 0.8]
    return spark.createDataFrame(rows, LOGITS)


def stepwise(spark, rows, logits, temperature, penalty, k, p, seed):
    """{(sample, window): figures} by the operators over one row per context and token."""
    ctx, rec = [], []
    for sample, no, ids, targets, _ in rows:
        for pos, (prev, target) in enumerate(zip(ids, targets)):
            ctx.append((f"{sample}:{no}:{pos}", prev, target))
            rec += [(f"{sample}:{no}:{pos}", q, ids[q]) for q in range(max(0, pos - 9), pos + 1)]
    ctx = spark.createDataFrame(ctx, "ctx_id string, prev_id int, target int")
    lg = H.apply_temperature(ctx.join(logits, "prev_id").select("ctx_id", "token_id", "logit"), temperature)
    pen = H.repetition_penalty(lg, spark.createDataFrame(rec, "ctx_id string, pos int, token_id int"), penalty)
    top = H.top_k_filter(pen, k)
    nucleus = H.nucleus_filter(top, p)
    probs = H.softmax(nucleus)
    out = {}
    for name, df in (("top", top), ("nucleus", nucleus)):
        for r in df.groupBy(F.substring_index("ctx_id", ":", 2).alias("w")).agg(F.count("*").alias("n"), F.sum("logit").alias("s")).collect():
            out.setdefault(r.w, {}).update({f"{name}_kept": r.n, f"{name}_sum": r.s})
    for r in probs.join(ctx, "ctx_id").groupBy(F.substring_index("ctx_id", ":", 2).alias("w")).agg(
            F.sum(F.when(F.col("token_id") == F.col("target"), F.col("prob")).otherwise(0)).alias("target_prob")).collect():
        out[r.w]["target_prob"] = r.target_prob
    for r in H.draw_token(probs, seed).collect():
        w, pos = r.ctx_id.rsplit(":", 1)
        out[w].setdefault("drawn", {})[int(pos)] = r.token_id
    return out


@pytest.mark.parametrize("low, temperature, penalty, k, p", [(0.0, 0.75, 1.15, 4, 0.9), (-3.0, 1.0, 1.5, 3, 0.7), (0.0, 0.5, 1.0, 0, 1.0),
                                                             (-2.0, 2.0, 3.0, 50, 0.5), (0.0, 1.0, 1.2, 1, 1.0)])
def test_equals_the_steps_over_a_logits_table(spark, low, temperature, penalty, k, p):
    rng = random.Random(repr((low, k, p)))
    w, rows = windows(spark, rng)
    logits = table(spark, rng, low=low)
    want = stepwise(spark, rows, logits, temperature, penalty, k, p, 7)
    got = H.sample_windows(w.repartition(3), logits, temperature, penalty, k, p, 7).collect()
    assert len(got) == len(rows)
    for r in got:
        x = want[f"{r.sample_id}:{r.window_no}"]
        assert (r.top_kept, r.nucleus_kept) == (x["top_kept"], x["nucleus_kept"])
        for c in ("top_sum", "nucleus_sum", "target_prob"):
            assert r[c] == pytest.approx(x[c])
        assert {i: t for i, t in enumerate(r.drawn) if t is not None} == x["drawn"]
        assert any(t is None for t in r.drawn) == any(i == 5 for s, no, ids, _, _ in rows if (s, no) == (r.sample_id, r.window_no) for i in ids)


def test_empty_windows_and_candidates(spark):
    rng = random.Random(1)
    w, _ = windows(spark, rng)
    none = spark.createDataFrame([], LOGITS)
    got = H.sample_windows(w, none).collect()
    assert len(got) == 6 and all(set(r.drawn) == {None} and r.top_kept == 0 for r in got)
    assert H.sample_windows(w.where("false"), table(spark, rng)).collect() == []


def test_cross_entropy_of_every_position(spark):
    rng = random.Random(2)
    w, rows = windows(spark, rng)
    counts = BG.bigram_fit(w)
    logits = counts.select("prev_id", F.col("next_id").alias("token_id"), F.log("n").alias("logit"))
    ctx = spark.createDataFrame([(f"{s}:{no}:{i}", p, t) for s, no, ids, ts, _ in rows for i, (p, t) in enumerate(zip(ids, ts))],
                                "ctx_id string, prev_id int, token_id int")
    ce = H.cross_entropy(ctx.select("ctx_id", "prev_id").join(logits, "prev_id").select("ctx_id", "token_id", "logit"), ctx.select("ctx_id", "token_id"))
    want = {r.w: r.ce for r in ce.groupBy(F.substring_index("ctx_id", ":", 2).alias("w")).agg(F.sum("ce").alias("ce")).collect()}
    got = {f"{r.sample_id}:{r.window_no}": r.nll_sum for r in BG.window_losses(w, counts, 0, 0.0).collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items()}
