"""F8 shuffle order and F9 batches, plus the distributed dense-position helper.

``dense_positions`` numbers rows 0..n-1 inside groups in a given order without a
single-partition window: range-partition + sort, freeze the ranged frame with a
reliable ``checkpoint()`` (shared folder), count rows per (partition, group)
— a table of size partitions × groups — turn the counts into offsets and add
each row's index inside its partition.  Hot groups are split over many range
partitions, so no task ever holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.schema import DEFAULT_BATCH_SIZE
from chatloom.session import checkpoint_dir

# offsets tables larger than this are joined by shuffle instead of broadcast
BROADCAST_ROWS = 1_000_000


def dense_positions(df: DataFrame, group_cols: list[str], order_cols: list[str], out_col: str = "pos",
                    partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 0-based rank of each row in its group by ``order_cols`` (must be unique)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    keys = [*group_cols, *order_cols]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys) \
        .withColumn("_pid", F.spark_partition_id())
    # freeze: range bounds come from sampling; both passes must see the same partitions
    frozen = ranged.checkpoint(eager=True).withColumn("_mid", F.monotonically_increasing_id())
    counts = frozen.groupBy("_pid", *group_cols).agg(F.count("*").alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1) \
        if group_cols else Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *group_cols, "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    n_off = offsets.count()
    if n_off <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    out = frozen.join(offsets, ["_pid", *group_cols])
    return out.withColumn(out_col, (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("long")) \
        .drop("_pid", "_mid", "_m0", "_off")


def shuffle_key(seed: int, epoch: Column | int, *ids: str) -> Column:
    """F8: deterministic pseudo-random order key, reproducible in any SQL engine (md5)."""
    ep = epoch if isinstance(epoch, Column) else F.lit(epoch)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), ep.cast("string"), *[F.col(c).cast("string") for c in ids]))


def shuffle_samples(windows: DataFrame, seed: int = 0, epochs: int = 1) -> DataFrame:
    """F8: one row per (epoch, window) with its shuffle key (narrow: epochs come from a generator)."""
    e = windows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    return e.withColumn("shuffle_key", shuffle_key(seed, F.col("epoch"), "sample_id", "window_no"))


def batch_windows(windows: DataFrame, seed: int = 0, epochs: int = 1,
                  batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """consecutive groups of ``batch_size`` in shuffled order per epoch; the last batch may be short."""
    keyed = shuffle_samples(windows, seed, epochs)
    pos = dense_positions(keyed, ["epoch"], ["shuffle_key", "sample_id", "window_no"])
    return pos.withColumn("batch_id", (F.col("pos") / F.lit(batch_size)).cast("long"))


def prefix_sum(df: DataFrame, group_col: str, order_cols: list[str], value_cols, out_cols,
               partitions: int | None = None) -> DataFrame:
    """Exclusive prefix sums of ``value_cols`` within ``group_col`` in ``order_cols`` order, distributed.

    Give it narrow rows (keys and numbers): they are range-partitioned, so a hot group spans many partitions, and
    frozen by a checkpoint.  Sums run in Spark's window inside each (partition, group); a group that began in an earlier
    partition adds what it had there.  Ranges are contiguous, so at most one group a partition did: the offset
    table has no more rows than there are partitions.
    """
    if isinstance(value_cols, str):
        value_cols, out_cols = [value_cols], [out_cols]
    spark = df.sparkSession
    checkpoint_dir(spark)
    keys = [group_col, *order_cols]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    frozen = df.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    before = Window.partitionBy("_pid", group_col).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    ran = frozen.select("*", *[F.sum(c).over(before).alias(f"_run_{c}") for c in value_cols])
    parts = Window.partitionBy(group_col).orderBy("_pid")
    earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
    offsets = frozen.groupBy("_pid", group_col).agg(*[F.sum(c).alias(f"_s_{c}") for c in value_cols]).select(
        F.col("_pid").alias("_opid"), F.col(group_col).alias("_ogroup"), F.row_number().over(parts).alias("_nth"),
        *[F.sum(f"_s_{c}").over(earlier).alias(f"_off_{c}") for c in value_cols]).where("_nth > 1")
    out = ran.join(F.broadcast(offsets), (F.col("_pid") == F.col("_opid")) & F.col(group_col).eqNullSafe(F.col("_ogroup")), "left")
    sums = {o: F.coalesce(F.col(f"_run_{c}"), F.lit(0)) + F.coalesce(F.col(f"_off_{c}"), F.lit(0))
            for c, o in zip(value_cols, out_cols)}
    return out.select(*df.columns, *[e.alias(o) for o, e in sums.items()])
