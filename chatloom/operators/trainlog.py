"""Training-log analytics over ``train_log`` / ``token_losses``.

Per-step work never runs as one window over a whole run or epoch: rolling means
slide over overlapping buckets of rows, epoch starts come from grouped aggregates.
Windows remain only over per-run *epoch* rows (a handful per run).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import checkpoint_dir

# fixed values: the trainer's logging and stopping rules
LOG_EVERY = 25            # status every 25th step
ROLLING = 100             # mean over the last <= 100 steps of the epoch
PATIENCE = 10             # early stop after 10 epochs without a significant drop
MIN_DELTA = 0.01          # a drop counts only when larger than this
CHECKPOINT_EVERY = 5      # periodic checkpoint every 5th epoch
NORM_EPS = 1e-8


def masked_batch_loss(token_losses: DataFrame, by=("run_id", "batch_id")) -> DataFrame:
    """G1: Σ(nll·mask)/Σmask per batch; NULL when nothing in the batch is supervised."""
    return token_losses.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("nll") * F.col("mask")), F.sum("mask")).alias("loss"),
        F.avg("mask").alias("mask_mean"))


def batch_loss_of_windows(window_losses: DataFrame, by=("run_id", "batch_id")) -> DataFrame:
    """G1 from per-window sums ``(nll_sum, n_masked, n_pos)``."""
    return window_losses.groupBy(*by).agg(
        F.try_divide(F.sum("nll_sum"), F.sum("n_masked")).alias("loss"),
        F.try_divide(F.sum("n_masked").cast("double"), F.sum("n_pos")).alias("mask_mean"))


def perplexity(train_log: DataFrame) -> DataFrame:
    """ppl = exp(loss) per step; per-epoch means are means of the exps."""
    return train_log.withColumn("ppl", F.exp("loss"))


def rolling_metrics(train_log: DataFrame, every: int = LOG_EVERY, window: int = ROLLING,
                    bucket: int = 4096) -> DataFrame:
    """At steps with step % every == 0, means over the last <= ``window`` rows of the same epoch.

    The plain sliding frame, but no task holds a whole (run, epoch): rows are numbered by distributed
    positions and cut into buckets of ``bucket`` rows; each bucket also gets the last ``window - 1`` rows of
    the one before it and returns its own rows only.  NaN, infinite and NULL values act within their frame
    and are forgotten after it (NULLs count neither in the sum nor in the number).
    """
    from chatloom.operators.batches import dense_positions
    bucket = max(bucket, window)
    vals = ["loss", "grad_norm", "mask_mean", "ppl"]
    x = dense_positions(perplexity(train_log).select("run_id", "epoch", "step", *vals), ["run_id", "epoch"], ["step"], "_pos")
    own = F.floor(F.col("_pos") / bucket)
    late = F.col("_pos") % bucket >= bucket - (window - 1)
    places = F.when(late, F.array(own, own + 1)).otherwise(F.array(own))
    y = x.withColumn("_own", own).withColumn("_b", F.explode(places))
    w = Window.partitionBy("run_id", "epoch", "_b").orderBy("_pos").rowsBetween(-(window - 1), 0)
    avg = [F.avg(v).over(w).alias(f"_avg_{v}") for v in vals]
    z = y.select("*", *avg).where((F.col("_b") == F.col("_own")) & (F.col("step") % every == 0))
    return z.select("run_id", "epoch", "step", *vals, F.col("_avg_loss").alias("avg_loss"),
                    F.col("_avg_grad_norm").alias("avg_grad"), F.col("_avg_mask_mean").alias("avg_mask"),
                    F.col("_avg_ppl").alias("avg_ppl"))


def epoch_loss(train_log: DataFrame) -> DataFrame:
    """Mean batch loss per (run, epoch) over the rows present (partial epochs included)."""
    return train_log.groupBy("run_id", "epoch").agg(F.avg("loss").alias("epoch_loss"),
                                                    F.count("*").alias("n_steps"))


def best_epochs(epochs: DataFrame) -> DataFrame:
    """Epochs that strictly lower the running best, flagged ``is_best`` for the overall minimum.

    A running minimum composes: key ranges of (run, epoch) are frozen, the minima of a run's ranges give each range the
    best before it, and only rows of one range meet in a window, however many epochs a run has.
    """
    spark = epochs.sparkSession
    checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = epochs.repartitionByRange(n, "run_id", "epoch").withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    before = Window.partitionBy("run_id").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    lows = ranged.groupBy("run_id", "_pid").agg(F.min("epoch_loss").alias("_low")) \
        .select("run_id", "_pid", F.min("_low").over(before).alias("_before"), F.min("_low").over(Window.partitionBy("run_id")).alias("_least"))
    own = Window.partitionBy("run_id", "_pid").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    x = ranged.withColumn("_own", F.min("epoch_loss").over(own)).join(lows, ["run_id", "_pid"]) \
        .withColumn("_prev", F.least("_before", "_own"))  # nulls are skipped
    x = x.where(F.col("_prev").isNull() | (F.col("epoch_loss") < F.col("_prev")))
    return x.withColumn("is_best", F.col("epoch_loss") == F.col("_least")).drop("_pid", "_before", "_least", "_own", "_prev")


def early_stop_epoch(epochs: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA) -> DataFrame:
    """Sequential fold per run over its (few) epochs.

    best falls only on a drop larger than ``min_delta`` (then wait = 0), otherwise
    wait + 1; training stops at the epoch where wait reaches ``patience``.
    """
    per_run = epochs.groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct("epoch", "epoch_loss"))).alias("e"))
    init = F.struct(F.lit(None).cast("double").alias("best"), F.lit(0).alias("wait"),
                    F.lit(None).cast("int").alias("stop"), F.lit(-1).alias("last"))

    def step(acc, x):
        running = acc["stop"].isNull()
        better = acc["best"].isNull() | (x["epoch_loss"] < acc["best"] - F.lit(min_delta))
        best = F.when(running & better, x["epoch_loss"]).otherwise(acc["best"])
        wait = F.when(~running, acc["wait"]).when(better, F.lit(0)).otherwise(acc["wait"] + 1)
        stop = F.when(running & (wait >= patience), x["epoch"].cast("int")).otherwise(acc["stop"])
        last = F.when(running, x["epoch"].cast("int")).otherwise(acc["last"])
        return F.struct(best.alias("best"), wait.alias("wait"), stop.alias("stop"), last.alias("last"))

    r = per_run.select("run_id", F.aggregate("e", init, step).alias("r"))
    return r.select("run_id", F.col("r.stop").alias("stop_epoch"), F.col("r.best").alias("best_loss"),
                    F.col("r.last").alias("last_epoch"))


def checkpoint_schedule(epochs: DataFrame, every: int = CHECKPOINT_EVERY, patience: int = PATIENCE,
                        min_delta: float = MIN_DELTA) -> DataFrame:
    """(run_id, epoch, kind) for kind in periodic / best / early_stop / final, epochs that ran only.

    One pass: the run-level stop fold joins the epoch rows, every label is a flag from
    one window over a run's epochs, and the flags are exploded (no union of branches).
    """
    stop = early_stop_epoch(epochs, patience, min_delta)
    ran = epochs.join(stop, "run_id").where(F.col("epoch") <= F.col("last_epoch"))
    w = Window.partitionBy("run_id").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    prev = F.min("epoch_loss").over(w)
    kinds = F.array(
        F.when((F.col("epoch") + 1) % every == 0, F.lit("periodic")),
        F.when(prev.isNull() | (F.col("epoch_loss") < prev), F.lit("best")),
        F.when(F.col("epoch") == F.col("stop_epoch"), F.lit("early_stop")),
        F.when(F.col("epoch") == F.col("last_epoch"), F.lit("final")))
    flagged = ran.select("run_id", "epoch", F.filter(kinds, lambda k: k.isNotNull()).alias("_kinds"))
    return flagged.select("run_id", "epoch", F.explode("_kinds").alias("kind"))


def throughput(train_log: DataFrame, every: int = LOG_EVERY) -> DataFrame:
    """At logging steps, batches done in the epoch / seconds since the epoch's first step.

    The epoch start is a grouped aggregate joined to the logging rows (no window over the epoch).
    """
    first = train_log.groupBy("run_id", "epoch").agg(F.min("step").alias("_s0"),
                                                      F.min(F.unix_micros("ts")).alias("_t0"))
    x = train_log.where(F.col("step") % every == 0).join(first, ["run_id", "epoch"])
    done = F.col("step") - F.col("_s0") + 1
    us = F.unix_micros("ts") - F.col("_t0")
    return x.select("run_id", "epoch", "step", done.alias("done"),
                    F.when(us > 0, done / (us / F.lit(1e6))).otherwise(F.lit(0.0)).alias("steps_per_sec"))


def l2_norm(values: DataFrame, by: list[str], col: str) -> DataFrame:
    """√Σ x² grouped (tensor norms combined into one)."""
    return values.groupBy(*by).agg(F.sqrt(F.sum(F.col(col) * F.col(col))).alias("l2"))


def norm_ratio(rolling: DataFrame, param_norms: DataFrame, eps: float = NORM_EPS) -> DataFrame:
    """Rolling grad norm / (parameter norm + eps) at logging steps."""
    j = rolling.join(param_norms, ["run_id", "epoch"], "left")
    return j.select("run_id", "epoch", "step", "avg_grad", "l2",
                    (F.col("avg_grad") / (F.col("l2") + F.lit(eps))).alias("gp_ratio"))
