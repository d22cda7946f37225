"""Dataset lifecycle — union, accumulate into a table, clear."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.schema import SAMPLES
from chatloom.sources.tables import conform


def union_samples(*frames: DataFrame) -> DataFrame:
    """Concatenate, duplicates kept (no shuffle)."""
    out = None
    for f in frames:
        f = conform(f)
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def accumulate_load(samples: DataFrame, table_path: str, load_no: int) -> DataFrame:
    """Add one load to a samples table; returns (load_no, added, total) read back from storage.

    A load is a partition of its own and is overwritten, so a load that is run again doesn't count twice.
    """
    conform(samples).write.mode("overwrite").parquet(f"{table_path}/load_no={load_no}")
    return load_report(samples.sparkSession, table_path)


def load_report(spark: SparkSession, table_path: str) -> DataFrame:
    t = spark.read.parquet(table_path)
    per = t.groupBy("load_no").agg(F.count("*").alias("added"))
    # one row per load: the running total is a window over the (few) load numbers
    from pyspark.sql import Window
    w = Window.orderBy("load_no").rowsBetween(Window.unboundedPreceding, 0)
    return per.select("load_no", "added", F.sum("added").over(w).alias("total"))


def clear_samples(spark: SparkSession, table_path: str) -> DataFrame:
    """Replace the table with an empty one and return it."""
    spark.createDataFrame([], SAMPLES).write.mode("overwrite").parquet(table_path)
    spark.createDataFrame([], SAMPLES).write.mode("overwrite").parquet(f"{table_path}/load_no=0")
    return spark.read.parquet(table_path)
