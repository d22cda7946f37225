"""Incremental loading with Structured Streaming.

Newly arrived files under ``input_dir`` are normalized and appended to a samples
table, with the number of added samples per trigger.  Files are routed by suffix, like
the batch loader does, and a file arrives whole in one micro-batch, so the batch
loader's rules apply unchanged in each of the three stateless streams:

* ``lines`` — ``*.jsonl`` files, read line by line (splittable);
* ``documents`` — ``*.json`` files read whole (``wholetext``), then sniffed like the
  batch reader: an array gives its items, an object one record, else JSON lines;
* ``texts`` — ``*.txt`` files read whole, one ``pretrain`` sample each.

The dialect is detected per file from its first valid record; ordinals, line numbers
and ids are the batch loader's.  Records of a file with no detected dialect are
quarantined as ``unknown_format``.  Files with any other suffix are not loaded;
``skipped_files`` lists them.

Each stream uses ``foreachBatch``: every micro-batch is written to
``…/stream=<name>/batch_id=<n>`` with overwrite, so a re-run of a batch after a
failure replaces rather than duplicates its output (exactly-once together with
the checkpoint).  The number of added samples is observed while they are written.

``update_totals`` keeps the running totals per format: a stateful aggregation over the
samples table as a stream, which reads one column of what was appended since its last run.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatloom.operators.normalize import formats, load_format
from chatloom.schema import QUARANTINE, SAMPLES


def _normalize(tagged: DataFrame):
    """(samples, quarantine) of records ``(file_path, ordinal, value, _v, format)``."""
    parts, quar = [], []
    for name, spec in formats().items():
        if spec.normalize is None:
            continue
        n = load_format(tagged.where(F.col("format") == name).select("file_path", "ordinal", "value", "_v"), name)
        parts.append(n.samples)
        quar.append(n.quarantine)
    other = tagged.where(F.col("format") == "json").select(
        "file_path", "ordinal", F.col("value").alias("raw"),
        F.when(F.json_object_keys("value").isNull(), F.lit("bad_json")).otherwise(F.lit("unknown_format"))
        .alias("reason"))
    samples = parts[0]
    for p in parts[1:]:
        samples = samples.unionByName(p)
    q = other.select(*QUARANTINE.names)
    for x in quar:
        q = q.unionByName(x.select(*QUARANTINE.names))
    return samples, q


def process_batch(batch: DataFrame, batch_id: int, output_dir: str, stream: str = "lines") -> None:
    """Normalize one micro-batch and write samples / quarantine / stats for it (idempotent)."""
    spark, recs = batch.sparkSession, None
    if stream == "texts":
        from chatloom.sources.files import text_file_samples
        samples, q = text_file_samples(batch.select("file_path", "value")), None
    else:
        # whole files: the batch loader's rules (per-file detection from the first valid record)
        from chatloom.sources.files import detect_formats, json_documents, line_records, records_quarantine
        recs = (line_records(batch) if stream == "lines" else json_documents(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        tagged = recs.where("valid").select("file_path", "ordinal", "value", "_v") \
            .join(detect_formats(recs), "file_path")
        samples, q = _normalize(tagged)
        q = records_quarantine(recs).select(*QUARANTINE.names).unionByName(q)
    part = f"stream={stream}/batch_id={batch_id}"
    seen = Observation()
    samples.observe(seen, F.count(F.lit(1)).alias("added")).write.mode("overwrite").parquet(f"{output_dir}/samples/{part}")
    if q is not None:
        q.write.mode("overwrite").parquet(f"{output_dir}/quarantine/{part}")
    spark.createDataFrame([(batch_id, seen.get["added"])], "batch long, added long") \
        .write.mode("overwrite").parquet(f"{output_dir}/stats/{part}")
    if recs is not None:
        recs.unpersist()


class IncrementalLoad:
    """The running streams of one ``incremental_load`` call (``lines``, ``documents`` and ``texts``)."""

    def __init__(self, queries: list[StreamingQuery]):
        self.queries = queries

    def awaitTermination(self) -> None:
        for q in self.queries:
            q.awaitTermination()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def incremental_load(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_location: str,
                     available_now: bool = True, max_files_per_trigger: int | None = None) -> IncrementalLoad:
    """Start the streams over ``input_dir`` (recursive); with ``available_now`` they process what has arrived and stop."""
    from chatloom.sources.files import GLOBS

    def start(stream: str, glob: str, whole: bool, ckpt: str) -> StreamingQuery:
        reader = spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", GLOBS[glob])
        if whole:
            reader = reader.option("wholetext", "true")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        src = reader.load(input_dir).select(F.col("_metadata.file_path").alias("file_path"),
                                            F.col("_metadata.file_block_start").alias("block"), "value")
        w = src.writeStream.foreachBatch(lambda df, bid: process_batch(df, bid, output_dir, stream)) \
            .option("checkpointLocation", ckpt)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
        return w.start()

    ck = checkpoint_location.rstrip("/")
    return IncrementalLoad([start("lines", "jsonl", False, ck), start("documents", "json", True, f"{ck}-documents"),
                            start("texts", "txt", True, f"{ck}-texts")])


def skipped_files(spark: SparkSession, input_dir: str) -> DataFrame:
    """(file_path, suffix) of the files below ``input_dir`` that no stream loads."""
    from chatloom.sources.files import list_files
    return list_files(spark, input_dir).where(~F.col("suffix").isin(".jsonl", ".json", ".txt"))


def read_samples(spark: SparkSession, output_dir: str) -> DataFrame:
    return spark.read.parquet(f"{output_dir}/samples")


def read_stats(spark: SparkSession, output_dir: str) -> DataFrame:
    """(stream, batch, added, total) — added per trigger and the running total (a few rows per trigger)."""
    from pyspark.sql import Window
    s = spark.read.parquet(f"{output_dir}/stats").select("stream", "batch", "added")
    w = Window.orderBy("batch", "stream").rowsBetween(Window.unboundedPreceding, 0)
    return s.withColumn("total", F.sum("added").over(w))


def update_totals(spark: SparkSession, output_dir: str, checkpoint_location: str) -> StreamingQuery:
    """Bring the totals per format up to date with the samples appended so far, and stop.

    A streaming aggregation whose state holds one count per format; each run reads only samples files that it has not
    seen.  Start it after ``IncrementalLoad.awaitTermination``: a batch that is being re-run replaces its files.
    """
    src = spark.readStream.schema(SAMPLES).option("recursiveFileLookup", "true").parquet(f"{output_dir}/samples")
    counts = src.groupBy(F.coalesce("format", F.lit("unknown")).alias("format")).agg(F.count(F.lit(1)).alias("total"))

    def write(df: DataFrame, batch_id: int) -> None:
        df.select("format", "total").coalesce(1).write.mode("overwrite").parquet(f"{output_dir}/totals/batch_id={batch_id}")

    return counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint_location) \
        .trigger(availableNow=True).start()


def read_totals(spark: SparkSession, output_dir: str) -> DataFrame:
    """(format, total) as of the last ``update_totals``: what ``load_stats`` counts over all samples."""
    t = spark.read.parquet(f"{output_dir}/totals")
    last = t.agg(F.max("batch_id").alias("_last"))
    return t.join(F.broadcast(last), F.col("batch_id") == F.col("_last")).select("format", "total")


__all__ = ["IncrementalLoad", "incremental_load", "process_batch", "read_samples", "read_stats", "read_totals", "skipped_files", "update_totals"]
