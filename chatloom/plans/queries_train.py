"""Queries for shuffle/batches (F8, F9), the bigram model (I1, I2), sampling (H1–H7)
and training-log analytics (G1–G9).

Inputs: windows of ``conversations`` (the flagship chain) and ``events`` read as a
training log: run_id = user_id % 5 (user_id for epoch queries), step = rank by (ts, event_id) within the run,
loss = value / 100, grad_norm = value / 10, mask_mean = props.k / 100.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import bigram as BG
from chatloom.operators import sampling as H
from chatloom.operators import trainlog as G
from chatloom.operators.batches import batch_windows, dense_positions, shuffle_samples
from chatloom.operators.windows import turn_table_windows, window_numbers
from chatloom.plans import oracle as O
from chatloom.plans.catalog import dialog_lengths, register
from chatloom.sources.tables import read_table

SEED = 0
EPOCHS = 2
BATCH = 8


def _r6(c):
    return F.round(c, 6)


# -- shared Spark inputs -----------------------------------------------------------------------------------
def dialog_windows(spark, d):
    return turn_table_windows(read_table(spark, d, "conversations"))


def _window_ids(spark, d):
    """(sample_id, window_no) from token counts; nothing is tokenized."""
    return window_numbers(dialog_lengths(spark, d), O.S, O.STRIDE).select("sample_id", "window_no")


def train_log(spark, d, epoch_len: int, runs: int | None = 5):
    """``runs``: users are dealt to so many runs; None makes each user a run of its own."""
    e = read_table(spark, d, "events").select(
        (F.col("user_id") % runs if runs else F.col("user_id")).alias("run_id"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
        (F.col("value") / 100).alias("loss"), (F.col("value") / 10).alias("grad_norm"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("mask_mean"))
    # step numbering without a per-run single task: range-partitioned dense ranks
    t = dense_positions(e, ["run_id"], ["ts", "event_id"], "step")
    return t.withColumn("epoch", (F.col("step") / epoch_len).cast("int"))


# -- shared oracle fragments ----------------------------------------------------------------------------------
WIN = O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids(), O.windows())

KEYED = """,
wins AS (SELECT DISTINCT sample_id, window_no FROM win),
keyed AS (
  SELECT sample_id, window_no, epoch,
         md5(concat_ws(':', '0', epoch::VARCHAR, sample_id, window_no::VARCHAR)) AS shuffle_key
  FROM (SELECT sample_id, window_no, unnest([0, 1]) AS epoch FROM wins)
),
batched AS (
  SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY shuffle_key, sample_id, window_no) - 1 AS pos
  FROM keyed
)"""

PAIRS = f""",
pairs AS (
  SELECT sample_id, window_no, off AS pos, id AS prev_id,
         lead(id) OVER (PARTITION BY sample_id, window_no ORDER BY off) AS next_id, mask
  FROM win
),
tp AS (SELECT * FROM pairs WHERE pos < {O.S}),
counts AS (SELECT prev_id, next_id, count(*) AS n FROM tp GROUP BY prev_id, next_id),
prevc AS (SELECT prev_id, sum(n) AS c_p FROM counts GROUP BY prev_id),
vsize AS (SELECT count(*) AS v FROM vocab),
nll AS (
  SELECT tp.*, -ln((c.n + 1.0) / (p.c_p + 1.0 * (SELECT v FROM vsize))) AS nll
  FROM tp JOIN counts c USING (prev_id, next_id) JOIN prevc p USING (prev_id)
)"""

# every input position of every window is a context; only a last token's first 50 candidates can reach its top 40
CTX = f""",
cand AS (
  SELECT prev_id, next_id AS token_id, ln(n) AS raw, ln(n) / 0.75 AS logit FROM (
    SELECT *, rank() OVER (PARTITION BY prev_id ORDER BY n DESC) AS rk FROM counts) WHERE rk <= 50
),
lists AS (SELECT sample_id, window_no, list(id ORDER BY off) AS ids FROM win GROUP BY sample_id, window_no),
places AS (SELECT sample_id, window_no, ids, unnest(range(0, {O.S})) AS pos FROM lists),
ctx AS (
  SELECT row_number() OVER () AS cid, sample_id, window_no, pos, ids[pos + 1] AS prev_id, ids[pos + 2] AS target_id,
         list_slice(ids, greatest(pos - 8, 1), pos + 1) AS recent FROM places
),
h2 AS (
  SELECT cid, token_id, logit AS before, list_contains(recent, token_id) AS hit,
         CASE WHEN list_contains(recent, token_id) THEN logit / 1.15 ELSE logit END AS logit
  FROM ctx JOIN cand USING (prev_id)
),
h3 AS (SELECT cid, token_id, logit FROM (SELECT *, rank() OVER (PARTITION BY cid ORDER BY logit DESC) AS rk FROM h2) WHERE rk <= 40),
h3m AS (SELECT *, logit - max(logit) OVER (PARTITION BY cid) AS z FROM h3),
h3p AS (SELECT *, exp(z) / sum(exp(z)) OVER (PARTITION BY cid) AS p FROM h3m),
h4 AS (SELECT cid, token_id, logit FROM (
         SELECT *, coalesce(sum(p) OVER (PARTITION BY cid ORDER BY logit DESC, token_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM h3p)
       WHERE before <= 0.9),
h5m AS (SELECT *, logit - max(logit) OVER (PARTITION BY cid) AS z FROM h4),
h5 AS (SELECT cid, token_id, logit, exp(z) / sum(exp(z)) OVER (PARTITION BY cid) AS prob FROM h5m),
h6 AS (
  SELECT cid, arg_min(token_id, rn) AS token_id FROM (
    SELECT h5.*, row_number() OVER w AS rn, sum(prob) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
           row_number() OVER w = count(*) OVER (PARTITION BY h5.cid) AS is_last,
           ('0x' || substr(md5(concat_ws(':', '0', sample_id, window_no, pos)), 1, 8))::BIGINT / 4294967296.0 AS u
    FROM h5 JOIN ctx USING (cid) WINDOW w AS (PARTITION BY h5.cid ORDER BY prob DESC, token_id)) WHERE cum > u OR is_last GROUP BY cid
)"""

# a window as a context by its last input token, with all that token's successors
LAST = f""",
ctx AS (
  SELECT sample_id || ':' || window_no AS ctx_id, max(id) FILTER (WHERE off = {O.S - 1}) AS last_id
  FROM win GROUP BY sample_id, window_no
),
logits AS (SELECT ctx_id, next_id AS token_id, ln(n) AS logit FROM ctx JOIN counts c ON c.prev_id = ctx.last_id)"""

TL = """tl AS (
  SELECT user_id % 5 AS run_id, ts, event_id, value / 100 AS loss, value / 10 AS grad_norm,
         json_extract(props, '$.k')::DOUBLE / 100 AS mask_mean,
         row_number() OVER (PARTITION BY user_id % 5 ORDER BY ts, event_id) - 1 AS step
  FROM events
)"""

# epochs of each user's own run: their number per run is bounded by the user's events
TLU = TL.replace("user_id % 5", "user_id")

EL = """,
el AS (SELECT run_id, step // 5 AS epoch, avg(loss) AS l, count(*) AS n FROM tl GROUP BY run_id, step // 5),
rec AS (
  SELECT run_id, epoch, l AS best, 0 AS wait, NULL::BIGINT AS stop FROM el WHERE epoch = 0
  UNION ALL
  SELECT r.run_id, e.epoch,
         CASE WHEN e.l < r.best - 0.01 THEN e.l ELSE r.best END,
         CASE WHEN e.l < r.best - 0.01 THEN 0 ELSE r.wait + 1 END,
         CASE WHEN (CASE WHEN e.l < r.best - 0.01 THEN 0 ELSE r.wait + 1 END) >= 10 THEN e.epoch END
  FROM rec r JOIN el e ON e.run_id = r.run_id AND e.epoch = r.epoch + 1
  WHERE r.stop IS NULL
),
stops AS (SELECT run_id, max(stop) AS stop_epoch, arg_max(best, epoch) AS best_loss, max(epoch) AS last_epoch
          FROM rec GROUP BY run_id)"""

ROLL = """,
tl2 AS (SELECT *, step // 250 AS epoch FROM tl),
roll AS (
  SELECT run_id, epoch, step,
         avg(loss) OVER w AS avg_loss, avg(grad_norm) OVER w AS avg_grad, avg(mask_mean) OVER w AS avg_mask,
         avg(exp(loss)) OVER w AS avg_ppl
  FROM tl2 WINDOW w AS (PARTITION BY run_id, epoch ORDER BY step ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
)"""


# -- F8 / F9 ------------------------------------------------------------------------------------------------
@register("shuffle_samples", WIN + KEYED + "SELECT sample_id, window_no, epoch, shuffle_key FROM keyed")
def q_shuffle_samples(spark, d):
    return shuffle_samples(_window_ids(spark, d), SEED, EPOCHS).select(
        "sample_id", "window_no", F.col("epoch").cast("int"), "shuffle_key")


@register("batch_windows", WIN + KEYED + """
SELECT epoch, sample_id, window_no, pos::BIGINT AS pos, (pos // 8)::BIGINT AS batch_id FROM batched""")
def q_batch_windows(spark, d):
    b = batch_windows(_window_ids(spark, d), SEED, EPOCHS, BATCH)
    return b.select(F.col("epoch").cast("int"), "sample_id", "window_no", "pos", "batch_id")


# -- I1 / I2 / G1 -----------------------------------------------------------------------------------------------
@register("bigram_fit", WIN + PAIRS + "SELECT prev_id, next_id, n::BIGINT AS n FROM counts")
def q_bigram_fit(spark, d):
    w, _ = dialog_windows(spark, d)
    return BG.bigram_fit(w).select("prev_id", "next_id", F.col("n").cast("long"))


def _window_losses(spark, d):
    """(sample_id, window_no, nll_sum, n_masked, n_pos): one row per window, never one per token.

    Windows take about 18 bytes a token, the text they come from one: they are cut anew to be scored, not kept.
    """
    w, v = dialog_windows(spark, d)
    return BG.window_losses(w, BG.bigram_fit(w), v.count())


@register("bigram_nll", WIN + PAIRS + """
SELECT sample_id, sum(mask)::BIGINT AS n_masked, round(sum(nll * mask) / sum(mask), 6) AS mean_nll,
       round(exp(sum(nll * mask) / sum(mask)), 6) AS ppl
FROM nll GROUP BY sample_id""")
def q_bigram_nll(spark, d):
    p = BG.sample_perplexity(_window_losses(spark, d))
    return p.select("sample_id", "n_masked", _r6("mean_nll").alias("mean_nll"), _r6("ppl").alias("ppl"))


@register("masked_batch_loss", WIN + PAIRS + KEYED + """
SELECT 0::BIGINT AS run_id, b.pos // 8 AS batch_id, round(sum(n.nll * n.mask) / nullif(sum(n.mask), 0), 6) AS loss,
       round(avg(n.mask), 6) AS mask_mean
FROM nll n JOIN batched b ON b.sample_id = n.sample_id AND b.window_no = n.window_no AND b.epoch = 0
GROUP BY b.pos // 8""")
def q_masked_batch_loss(spark, d):
    # batch ids join at window level
    b = batch_windows(_window_ids(spark, d), SEED, 1, BATCH).select("sample_id", "window_no", "batch_id")
    x = _window_losses(spark, d).join(b, ["sample_id", "window_no"]).withColumn("run_id", F.lit(0).cast("long"))
    r = G.batch_loss_of_windows(x)
    return r.select("run_id", F.col("batch_id").cast("long"), _r6("loss").alias("loss"),
                    _r6("mask_mean").alias("mask_mean"))


# -- H1–H7 ------------------------------------------------------------------------------------------------
def _model(spark, d):
    """Windows and logits(prev_id, token_id, logit = ln count) of their bigrams."""
    w, _ = dialog_windows(spark, d)
    counts = BG.bigram_fit(w)
    return w, counts.select("prev_id", F.col("next_id").alias("token_id"), F.log("n").alias("logit")), counts


def _sampled(spark, d, *figures):
    """H1–H6 at every position up to the step that gives ``figures``, one row a window."""
    w, logits, _ = _model(spark, d)
    return H.sample_windows(w, logits, 0.75, 1.15, 40, 0.9, SEED, figures=figures)


def _r3(c):
    return F.round(c, 3).alias(c)


@register("apply_temperature", WIN + PAIRS + LAST + """
SELECT ctx_id, token_id, round(logit / 0.75, 6) AS logit FROM logits""")
def q_apply_temperature(spark, d):
    """H1 over every successor of each window's last input token."""
    w, logits, _ = _model(spark, d)
    ctx = w.select(F.concat_ws(":", "sample_id", F.col("window_no").cast("string")).alias("ctx_id"),
                   F.element_at("input_ids", -1).alias("prev_id"))
    scaled = H.apply_temperature(ctx.join(logits, "prev_id").select("ctx_id", "token_id", "logit"), 0.75)
    return scaled.select("ctx_id", "token_id", _r6("logit").alias("logit"))


@register("repetition_penalty", WIN + PAIRS + CTX + """
SELECT sample_id, window_no, count(*) FILTER (WHERE hit) AS hits, round(sum(before - logit), 3) AS cut
FROM h2 JOIN ctx USING (cid) GROUP BY sample_id, window_no""")
def q_repetition_penalty(spark, d):
    return _sampled(spark, d, "hits", "cut").select("sample_id", "window_no", "hits", _r3("cut"))


@register("top_k_filter", WIN + PAIRS + CTX + """
SELECT sample_id, window_no, count(*) AS top_kept, round(sum(logit), 3) AS top_sum
FROM h3 JOIN ctx USING (cid) GROUP BY sample_id, window_no""")
def q_top_k_filter(spark, d):
    return _sampled(spark, d, "top_kept", "top_sum").select("sample_id", "window_no", "top_kept", _r3("top_sum"))


@register("nucleus_filter", WIN + PAIRS + CTX + """
SELECT sample_id, window_no, count(*) AS nucleus_kept, round(sum(logit), 3) AS nucleus_sum
FROM h4 JOIN ctx USING (cid) GROUP BY sample_id, window_no""")
def q_nucleus_filter(spark, d):
    return _sampled(spark, d, "nucleus_kept", "nucleus_sum").select("sample_id", "window_no", "nucleus_kept", _r3("nucleus_sum"))


@register("softmax", WIN + PAIRS + CTX + """
SELECT sample_id, window_no, round(coalesce(sum(target), 0), 3) AS target_prob, round(sum(best), 3) AS best_prob FROM (
  SELECT cid, max(prob) AS best, max(prob) FILTER (WHERE token_id = target_id) AS target FROM h5 JOIN ctx USING (cid) GROUP BY cid)
JOIN ctx USING (cid) GROUP BY sample_id, window_no""")
def q_softmax(spark, d):
    return _sampled(spark, d, "target_prob", "best_prob").select("sample_id", "window_no", _r3("target_prob"), _r3("best_prob"))


@register("draw_token", WIN + PAIRS + CTX + """
SELECT sample_id, window_no, string_agg(token_id::VARCHAR, ',' ORDER BY pos) AS drawn
FROM h6 JOIN ctx USING (cid) GROUP BY sample_id, window_no""")
def q_draw_token(spark, d):
    return _sampled(spark, d, "drawn").select("sample_id", "window_no", F.array_join(F.col("drawn").cast("array<string>"), ",").alias("drawn"))


@register("cross_entropy", WIN + PAIRS + """
SELECT sample_id, window_no, round(sum(ln(p.c_p) - ln(c.n)), 3) AS ce, count(*) AS n_pos
FROM tp JOIN counts c USING (prev_id, next_id) JOIN prevc p USING (prev_id) GROUP BY sample_id, window_no""")
def q_cross_entropy(spark, d):
    """H7 at every position: the log-sum-exp of a last token's ln counts is the ln of their total."""
    w, _, counts = _model(spark, d)
    every = w.withColumn("loss_mask", F.transform("loss_mask", lambda m: F.lit(1).cast("tinyint")))
    return BG.window_losses(every, counts, 0, 0.0).select("sample_id", "window_no", F.round("nll_sum", 3).alias("ce"), "n_pos")


# -- G2–G9 ------------------------------------------------------------------------------------------------------
@register("perplexity", O.with_(TL) + """
SELECT run_id, step // 50 AS epoch, round(avg(exp(loss)), 6) AS avg_ppl, round(avg(loss), 6) AS avg_loss
FROM tl GROUP BY run_id, step // 50""")
def q_perplexity(spark, d):
    t = G.perplexity(train_log(spark, d, 50))
    return t.groupBy("run_id", F.col("epoch").cast("long").alias("epoch")).agg(
        _r6(F.avg("ppl")).alias("avg_ppl"), _r6(F.avg("loss")).alias("avg_loss"))


@register("rolling_metrics", O.with_(TL) + ROLL + """
SELECT run_id, step::BIGINT AS step, round(avg_loss, 6) AS avg_loss, round(avg_grad, 6) AS avg_grad,
       round(avg_mask, 6) AS avg_mask, round(avg_ppl, 6) AS avg_ppl
FROM roll WHERE step % 25 = 0""")
def q_rolling_metrics(spark, d):
    r = G.rolling_metrics(train_log(spark, d, 250))
    return r.select("run_id", "step", *[_r6(c).alias(c) for c in ("avg_loss", "avg_grad", "avg_mask", "avg_ppl")])


@register("epoch_loss", O.with_(TLU) + EL + """
SELECT run_id, epoch::BIGINT AS epoch, round(l, 6) AS epoch_loss, n::BIGINT AS n_steps FROM el""")
def q_epoch_loss(spark, d):
    e = G.epoch_loss(train_log(spark, d, 5, None))
    return e.select("run_id", F.col("epoch").cast("long"), _r6("epoch_loss").alias("epoch_loss"),
                    F.col("n_steps").cast("long"))


@register("best_epoch", O.with_(TLU) + EL + """
SELECT run_id, epoch::BIGINT AS epoch, round(l, 6) AS epoch_loss, l = min(l) OVER (PARTITION BY run_id) AS is_best
FROM (SELECT *, min(l) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
      FROM el) WHERE prev IS NULL OR l < prev""")
def q_best_epoch(spark, d):
    b = G.best_epochs(G.epoch_loss(train_log(spark, d, 5, None)))
    return b.select("run_id", F.col("epoch").cast("long"), _r6("epoch_loss").alias("epoch_loss"), "is_best")


@register("early_stop_epoch", O.with_(TLU, recursive=True) + EL + """
SELECT run_id, stop_epoch::BIGINT AS stop_epoch, round(best_loss, 6) AS best_loss, last_epoch::BIGINT AS last_epoch
FROM stops""")
def q_early_stop_epoch(spark, d):
    s = G.early_stop_epoch(G.epoch_loss(train_log(spark, d, 5, None)))
    return s.select("run_id", F.col("stop_epoch").cast("long"), _r6("best_loss").alias("best_loss"),
                    F.col("last_epoch").cast("long"))


@register("checkpoint_schedule", O.with_(TLU, recursive=True) + EL + """,
ran AS (SELECT el.*, s.stop_epoch, s.last_epoch FROM el JOIN stops s USING (run_id) WHERE el.epoch <= s.last_epoch),
bests AS (SELECT run_id, epoch FROM (
  SELECT *, min(l) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM ran) WHERE prev IS NULL OR l < prev)
SELECT run_id, epoch::BIGINT AS epoch, 'periodic' AS kind FROM ran WHERE (epoch + 1) % 5 = 0
UNION ALL SELECT run_id, epoch::BIGINT, 'best' FROM bests
UNION ALL SELECT run_id, epoch::BIGINT, 'early_stop' FROM ran WHERE epoch = stop_epoch
UNION ALL SELECT run_id, epoch::BIGINT, 'final' FROM ran WHERE epoch = last_epoch""")
def q_checkpoint_schedule(spark, d):
    c = G.checkpoint_schedule(G.epoch_loss(train_log(spark, d, 5, None)))
    return c.select("run_id", F.col("epoch").cast("long"), "kind")


@register("throughput", O.with_(TL) + """,
tl2 AS (SELECT *, step // 250 AS epoch FROM tl),
x AS (SELECT run_id, step, step - min(step) OVER (PARTITION BY run_id, epoch) + 1 AS done,
             epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run_id, epoch) AS us FROM tl2)
SELECT run_id, step::BIGINT AS step, done::BIGINT AS done,
       round(CASE WHEN us > 0 THEN done / (us / 1e6) ELSE 0 END, 6) AS steps_per_sec
FROM x WHERE step % 25 = 0""")
def q_throughput(spark, d):
    t = G.throughput(train_log(spark, d, 250))
    return t.select("run_id", "step", F.col("done").cast("long"), _r6("steps_per_sec").alias("steps_per_sec"))


@register("norm_ratio", O.with_(TL) + ROLL + """,
pn AS (SELECT run_id, epoch, sqrt(sum(loss * loss)) AS l2 FROM tl2 GROUP BY run_id, epoch)
SELECT r.run_id, r.step::BIGINT AS step, round(p.l2, 6) AS l2, round(r.avg_grad / (p.l2 + 1e-8), 6) AS gp_ratio
FROM roll r JOIN pn p USING (run_id, epoch) WHERE r.step % 25 = 0""")
def q_norm_ratio(spark, d):
    t = train_log(spark, d, 250).cache()
    r = G.norm_ratio(G.rolling_metrics(t), G.l2_norm(t, ["run_id", "epoch"], "loss"))
    return r.select("run_id", "step", _r6("l2").alias("l2"), _r6("gp_ratio").alias("gp_ratio"))
