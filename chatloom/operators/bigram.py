"""A count-based next-token model as a Spark-native producer of losses and logits.

(A re-aim: the transformer itself is out of scope; the *train → loss → perplexity*
contract is kept with bigram counts.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.kernels import row_slices

# counts tables up to this many rows are sent to a kernel; larger ones are joined
BROADCAST_ROWS = 2_000_000


def token_pairs(windows: DataFrame, keep=("sample_id", "window_no")) -> DataFrame:
    """(…, pos, prev_id, next_id, mask): one row per input position of every window."""
    z = F.arrays_zip(F.col("input_ids").alias("prev_id"), F.col("target_ids").alias("next_id"),
                     F.col("loss_mask").alias("mask"))
    return windows.select(*keep, F.posexplode(z).alias("pos", "p")).select(
        *keep, "pos", F.col("p.prev_id").alias("prev_id"), F.col("p.next_id").alias("next_id"),
        F.col("p.mask").cast("int").alias("mask"))


PAIR_CELLS = 1 << 22   # (prev, next) cells that a task counts in a dense table; beyond that it sorts the pairs of a slice


def _pair_count_kernel(mask_only: bool):
    """Distinct (prev, next) pairs with counts, never one per token: per task where ids are small, else per slice of a batch."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def pairs(prev, nxt, n):
            return pa.RecordBatch.from_arrays([pa.array(prev.astype(np.int32)), pa.array(nxt.astype(np.int32)),
                                               pa.array(n.astype(np.int64))], names=["prev_id", "next_id", "n"])

        table = np.zeros((0, 0), dtype=np.int64)
        for b in batches:
            for part in row_slices(b, 0):
                flat = []
                for col in part.columns[:3 if mask_only else 2]:
                    offs = col.offsets.to_numpy()
                    flat.append(col.values.to_numpy(zero_copy_only=False)[offs[0]:offs[-1]])
                a, t = flat[:2]
                if mask_only:
                    a, t = a[flat[2] == 1], t[flat[2] == 1]
                if not len(a):
                    continue
                side = int(max(a.max(), t.max())) + 1
                if side * side <= PAIR_CELLS and min(a.min(), t.min()) >= 0:
                    if side > len(table):
                        wider = np.zeros((side, side), dtype=np.int64)
                        wider[:len(table), :len(table)] = table
                        table = wider
                    side = len(table)
                    table += np.bincount(a.astype(np.int64) * side + t, minlength=side * side).reshape(side, side)
                else:
                    uniq, cnt = np.unique((a.astype(np.int64) << 32) | t.astype(np.int64), return_counts=True)
                    yield pairs(uniq >> 32, uniq & 0xFFFFFFFF, cnt)
        if table.any():
            prev, nxt = np.nonzero(table)
            yield pairs(prev, nxt, table[prev, nxt])
    return run


def bigram_fit(windows: DataFrame, mask_only: bool = False) -> DataFrame:
    """Counts of (input token, target token) over all window positions.

    Windows are reduced to their distinct pairs in numpy first, so the shuffle carries at most V² rows per task (per
    slice of a batch where V² is over ``PAIR_CELLS``) instead of one row per token.
    """
    from chatloom.plans.runtime import ensure_package
    ensure_package(windows.sparkSession)
    part = windows.select("input_ids", "target_ids", "loss_mask").mapInArrow(
        _pair_count_kernel(mask_only), "prev_id int, next_id int, n long")
    return part.groupBy("prev_id", "next_id").agg(F.sum("n").alias("n"))


def bigram_nll(pairs: DataFrame, counts: DataFrame, vocab_size: int, alpha: float = 1.0) -> DataFrame:
    """nll = −ln((c(prev,next)+α) / (c(prev)+α·V)) for every pair row."""
    pair_c = counts.select("prev_id", "next_id", F.col("n").alias("c_pn"))  # joined as their sizes at run time ask for
    prev_c = counts.groupBy("prev_id").agg(F.sum("n").alias("c_p"))
    j = pairs.join(pair_c, ["prev_id", "next_id"], "left").join(prev_c, "prev_id", "left")
    nll = -F.log((F.coalesce("c_pn", F.lit(0)) + F.lit(alpha)) /
                 (F.coalesce("c_p", F.lit(0)) + F.lit(alpha * vocab_size)))
    return j.withColumn("nll", nll).drop("c_pn", "c_p")


def _loss_kernel(bc, n_keep: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        keys, pair_n, prevs, prev_n, vocab_size, alpha = bc.value
        for b in (part for whole in batches for part in row_slices(whole, n_keep)):
            n = b.num_rows
            if n == 0:
                continue
            flat = []
            for i in range(n_keep, n_keep + 3):
                col = b.column(i)
                offs = col.offsets.to_numpy()
                flat.append(col.values.to_numpy(zero_copy_only=False)[offs[0]:offs[-1]].astype(np.int64))
            starts = offs[:-1] - offs[0]
            prev, nxt, mask = flat
            key = (prev << 32) | nxt
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            c_pn = np.where(keys[at] == key, pair_n[at], 0)
            at = np.minimum(np.searchsorted(prevs, prev), len(prevs) - 1)
            c_p = np.where(prevs[at] == prev, prev_n[at], 0)
            nll = -np.log((c_pn + alpha) / (c_p + alpha * vocab_size))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n_keep], pa.array(np.add.reduceat(nll * mask, starts)),
                 pa.array(np.add.reduceat(mask, starts)), pa.array(np.diff(offs).astype(np.int64))],
                names=[*b.schema.names[:n_keep], "nll_sum", "n_masked", "n_pos"])
    return run


def window_losses(windows: DataFrame, counts: DataFrame, vocab_size: int, alpha: float = 1.0,
                  keep=("sample_id", "window_no")) -> DataFrame:
    """I2 per window: ``(*keep, nll_sum, n_masked, n_pos)``, Σ nll·mask and Σ mask over its positions.

    Counts of up to ``BROADCAST_ROWS`` pairs (16 bytes each) are broadcast to an Arrow kernel; beyond that the
    pairs are joined by shuffle and summed.
    """
    from chatloom.plans.runtime import ensure_package
    spark = windows.sparkSession
    counts = counts.select("prev_id", "next_id", "n")
    head = counts.limit(BROADCAST_ROWS + 1).toArrow()
    if head.num_rows > BROADCAST_ROWS or head.num_rows == 0:
        tl = bigram_nll(token_pairs(windows, keep), counts, vocab_size, alpha)
        return tl.groupBy(*keep).agg(F.sum(F.col("nll") * F.col("mask")).alias("nll_sum"),
                                     F.sum("mask").cast("long").alias("n_masked"), F.count(F.lit(1)).alias("n_pos"))
    import numpy as np
    ensure_package(spark)
    prev, nxt, n = (head.column(c).to_numpy().astype(np.int64) for c in ("prev_id", "next_id", "n"))
    key = (prev << 32) | nxt
    order = np.argsort(key)
    prevs, where = np.unique(prev, return_inverse=True)
    totals = np.bincount(where, weights=n).astype(np.int64)
    bc = spark.sparkContext.broadcast((key[order], n[order], prevs, totals, vocab_size, alpha))
    src = windows.select(*keep, "input_ids", "target_ids", "loss_mask")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields[:len(keep)])
    return src.mapInArrow(_loss_kernel(bc, len(keep)), f"{kept}, nll_sum double, n_masked long, n_pos long")


def sample_perplexity(window_losses: DataFrame, by: str = "sample_id") -> DataFrame:
    """I2 tail: masked mean nll and perplexity per sample (NULL when nothing is supervised)."""
    return window_losses.groupBy(by).agg(
        F.sum("n_masked").cast("long").alias("n_masked"),
        F.try_divide(F.sum("nll_sum"), F.sum("n_masked")).alias("mean_nll"),
    ).withColumn("ppl", F.exp("mean_nll"))
