"""A9–A12 sinks: split export, manifest, known-field projection, typed window shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.sources.fs import list_parts, move, remove_tree

# fixed values: text fields an export keeps when asked for known fields only
KNOWN_FIELDS = ["text", "content", "instruction", "output", "input", "conversation"]


def select_known_fields(df: DataFrame) -> DataFrame:
    """Keep only the known text fields that exist (Catalyst prunes the rest at the scan)."""
    keep = [c for c in KNOWN_FIELDS if c in df.columns]
    return df.select(*keep)


def export_splits_jsonl(df: DataFrame, path: str, split_col: str = "split", columns: list[str] | None = None,
                        max_records_per_file: int = 0) -> dict[str, list[str]]:
    """One ``<split>.jsonl`` per split, rows written in full, UTF-8; returns the file names of each split.

    A split that several tasks wrote, or one beyond ``max_records_per_file``, has ``<split>-00000.jsonl`` and so on.
    Spark's committed writer makes the files below ``_staging``; only whole exports are then renamed into place, and
    ``_staging`` goes.  A null split is named ``default``; ``/`` and other awkward characters stay percent-encoded.
    """
    spark = df.sparkSession
    out = df if columns is None else df.select(*columns, split_col)
    staging = f"{path.rstrip('/')}/_staging"
    # the split stands in every row as well as in the name of its folder
    out.withColumn("_split", F.col(split_col).cast("string")).write.mode("overwrite").option("ignoreNullFields", "false") \
        .option("maxRecordsPerFile", max_records_per_file).partitionBy("_split").json(staging)
    names: dict[str, list[str]] = {}
    for part in list_parts(spark, staging):
        folder = part.split("/")[0].removeprefix("_split=")
        names.setdefault("default" if folder == "__HIVE_DEFAULT_PARTITION__" else folder, []).append(part)
    for split, parts in names.items():
        files = [f"{split}.jsonl"] if len(parts) == 1 else [f"{split}-{i:05d}.jsonl" for i in range(len(parts))]
        for part, name in zip(parts, files):
            move(spark, f"{staging}/{part}", f"{path.rstrip('/')}/{name}")
        names[split] = files
    remove_tree(spark, staging)
    return names


def export_manifest(df: DataFrame, dataset: str, split_col: str = "split", split: str | None = None) -> DataFrame:
    """A10: one-row manifest (dataset, splits, split_counts, total_samples, files) from per-split counts."""
    src = df if split is None else df.where(F.col(split_col) == split)
    per = src.groupBy(F.col(split_col).cast("string").alias("split")).agg(F.count("*").alias("n"))
    return per.agg(
        F.lit(dataset).alias("dataset"),
        F.array_sort(F.collect_list("split")).alias("splits"),
        F.array_sort(F.collect_list(F.struct("split", "n"))).alias("split_counts"),
        F.sum("n").cast("long").alias("total_samples"),
        F.count("*").cast("long").alias("files"),
    )


MANIFEST = "dataset_info.json"


def write_manifest(manifest: DataFrame, path: str) -> None:
    """A10: the manifest as the file ``dataset_info.json`` below ``path`` (it is a single row)."""
    spark = manifest.sparkSession
    staging = f"{path.rstrip('/')}/_manifest"
    manifest.coalesce(1).write.mode("overwrite").json(staging)
    move(spark, f"{staging}/{list_parts(spark, staging)[0]}", f"{path.rstrip('/')}/{MANIFEST}")
    remove_tree(spark, staging)


def export_dataset(df: DataFrame, path: str, dataset: str, split_col: str = "split", columns: list[str] | None = None,
                   max_records_per_file: int = 0) -> DataFrame:
    """A9 + A10: the splits as JSON lines and beside them the manifest, which is returned as written.

    The manifest counts what the files hold: it is taken from the exported rows, of which only the split is read.
    """
    spark = df.sparkSession
    export_splits_jsonl(df, path, split_col, columns, max_records_per_file)
    # without rows there are no files to read
    back = spark.read.option("pathGlobFilter", "*.jsonl").schema(f"`{split_col}` string").json(path)
    write_manifest(export_manifest(back, dataset, split_col), path)
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("dataset string, splits array<string>, split_counts array<struct<split:string,n:bigint>>, "
                             "total_samples bigint, files bigint").json(f"{path.rstrip('/')}/{MANIFEST}")


def read_split_export(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an export's ``*.jsonl`` files."""
    return spark.read.option("pathGlobFilter", "*.jsonl").json(path)


def typed_windows(windows: DataFrame) -> DataFrame:
    """The trainer's view — int64 ids and boolean mask."""
    return windows.select(
        "sample_id", "window_no",
        F.col("input_ids").cast("array<bigint>").alias("input_ids"),
        F.col("target_ids").cast("array<bigint>").alias("target_ids"),
        F.transform("loss_mask", lambda m: m == 1).alias("loss_mask"))


def write_windows(windows: DataFrame, path: str, max_records_per_file: int = 100_000, mode: str = "overwrite") -> None:
    """Materialize typed windows as Parquet shards of bounded size."""
    typed_windows(windows).write.mode(mode).option("maxRecordsPerFile", max_records_per_file).parquet(path)
