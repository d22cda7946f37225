"""Table sources: turn-per-row dialog tables, text tables, arbitrary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.schema import SAMPLE_COLUMNS, SAMPLES


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dialog_key(df: DataFrame, id_col: str):
    """A dialog id as kernels carry it: integers as long, anything else as string."""
    kind = df.schema[id_col].dataType.simpleString()
    return F.col(id_col).cast("long" if kind in ("tinyint", "smallint", "int", "bigint") else "string")


def spread_scan(df: DataFrame) -> DataFrame:
    """Give a *scan* at least one partition per core before CPU-heavy Python stages.

    Only for plans without an exchange (reading the partition count of a scan is
    planning only).  On a cluster, scans have far more splits than cores and
    this is a no-op.
    """
    sc = df.sparkSession.sparkContext
    if df.rdd.getNumPartitions() < sc.defaultParallelism:
        return df.repartition(sc.defaultParallelism)
    return df


def conform(df: DataFrame) -> DataFrame:
    """Project onto the canonical ``samples`` schema (missing columns are NULL)."""
    cols = []
    for f in SAMPLES.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def assemble_dialogs(
    turns: DataFrame,
    id_col: str = "conv_id",
    order_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    source_name: str = "conversations",
    repartition: bool = True,
) -> DataFrame:
    """Turn-per-row table -> one ``samples`` row per dialog, turns in order.

    One hash shuffle on the dialog id: the explicit ``repartition`` fixes the
    partition count (``spark.sql.shuffle.partitions``) so that the Python window
    kernel downstream gets that parallelism, and the ``groupBy`` reuses the same
    exchange.  ``collect_list`` state per group is one dialog.
    """
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = turns.repartition(n, id_col) if repartition else turns
    g = src.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(role_col).alias("role"),
                                             F.col(text_col).alias("content")))).alias("_t")
    )
    dialog = F.transform("_t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    key = F.concat(F.lit(source_name + ":"), F.col(id_col).cast("string"))
    out = g.select(
        key.alias("sample_id"),
        F.lit("dialog").alias("kind"),
        dialog.alias("dialog"),
        key.alias("source"),
        F.lit(source_name).alias("file_path"),
        F.col(id_col).try_cast("long").alias("ordinal"),
        F.lit("sft").alias("type"),
        F.size(F.filter("_t", lambda x: x["role"] == "assistant")).alias("turns"),
        F.lit("table").alias("format"),
    )
    return conform(out)


def text_samples(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_name: str = "documents",
    sample_type: str = "pretrain",
) -> DataFrame:
    """Text table -> ``samples`` rows of kind 'text' (one per row; narrow, no shuffle)."""
    key = F.concat(F.lit(source_name + ":"), F.col(id_col).cast("string"))
    return conform(df.select(
        key.alias("sample_id"),
        F.lit("text").alias("kind"),
        F.col(text_col).alias("text"),
        key.alias("source"),
        F.lit(source_name).alias("file_path"),
        F.col(id_col).cast("long").alias("ordinal"),
        F.lit(sample_type).alias("type"),
        F.lit("table").alias("format"),
    ))


# fixed values: candidate text columns in preference order
TEXT_COLUMN_CANDIDATES = ["text", "content", "sentence", "input", "instruction", "output"]


def resolve_text_column(df: DataFrame, text_column: str = "text", source_name: str = "table",
                        split: str = "train") -> DataFrame:
    """Pick the text column at schema time, else per row the first string longer than 50.

    Rows whose chosen value is NULL or empty are dropped; every other column goes
    to ``metadata`` as JSON, NULL fields included.  Type is 'sft'.  Kept rows are numbered
    in scan order: the number is ``ordinal`` and ends ``source``, so ids are unique even
    for rows that repeat.  Numbers come from per-partition counts and offsets (no global
    sort); the frame must give the same partitions when it is read again, as a file scan
    does — checkpoint anything else first.
    """
    names = df.columns
    chosen = text_column if text_column in names else next((c for c in TEXT_COLUMN_CANDIDATES if c in names), None)
    if chosen is not None:
        text = F.col(chosen).cast("string")
        rest = [c for c in names if c != text_column]
    else:
        string_cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
        text = F.coalesce(*[F.when(F.char_length(c) > 50, F.col(c)) for c in string_cols]) if string_cols else F.lit(None)
        rest = names
    meta = F.to_json(F.struct(*[F.col(c) for c in rest]), {"ignoreNullFields": "false"}) if rest else F.lit(None)
    kept = df.select(text.alias("text"), meta.alias("metadata")).where(F.col("text").isNotNull() & (F.col("text") != "")) \
        .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    parts = kept.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    parts = parts.select(F.col("_pid").alias("_p"), "_m0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = kept.join(parts, F.col("_pid") == F.col("_p")) \
        .withColumn("ordinal", F.col("_off") + F.col("_mid") - F.col("_m0")) \
        .withColumn("source", F.concat(F.lit(f"hf://{source_name}/{split}:"), F.col("ordinal").cast("string")))
    out = out.select(
        F.sha2("source", 256).alias("sample_id"),
        F.lit("text").alias("kind"),
        "text",
        "source",
        "ordinal",
        F.lit("sft").alias("type"),
        "metadata",
        F.lit("table").alias("format"),
    )
    return conform(out)


__all__ = ["read_table", "conform", "assemble_dialogs", "text_samples", "resolve_text_column", "SAMPLE_COLUMNS"]
