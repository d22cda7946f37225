"""Helpers shared by the corpus operators: lineage cuts and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.plans.runtime import ensure_package
from chatloom.session import checkpoint_dir


def prepare(spark: SparkSession) -> None:
    """Make the kernels importable on executors and set the shared checkpoint folder."""
    checkpoint_dir(spark)
    ensure_package(spark)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder (survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def numbered(df: DataFrame) -> DataFrame:
    """The frame with its columns renamed c0, c1, ...: no column can clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["x"], row["s"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node that has an edge; component = smallest reachable node.

    Alternating large-star / small-star steps (O(log^2 n) rounds, any diameter).  Only minima and
    joins: no neighbour list is ever gathered, so a node with very many edges is split like any
    skewed join.  Each round is cut with a reliable checkpoint; the stop test is a fingerprint of
    the edge set, the only value that reaches the driver.
    Null ends and self loops are ignored; no edges gives no rows.
    """
    cur = cut(edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
              .where("u is not null and v is not null and u > v").distinct())
    seen = _signature(cur)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = cut(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = _signature(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
