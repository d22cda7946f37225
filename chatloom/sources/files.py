"""Scan directories of JSONL / JSON / TXT files into ``samples`` + ``quarantine``.

Plan shape (no driver-side loops over data, no global sort):

* listing: ``binaryFile`` source with only ``path`` selected (content is never read);
* ``.jsonl``: line-mode ``text`` scan (splittable); record ordinals come from
  per-(file, split) counts, a prefix sum over the few splits of each file and a
  join back (AQE broadcasts the small split table when it is small);
* ``.json``: scan in splits cut at commas, sniffed by content — a JSON array, one object, or
  JSON lines inside a ``.json`` file (``json_split``);
* ``.txt``: whole-file scan, one ``pretrain`` sample per file, ``\\r\\n`` → ``\\n``;
* format detection is a minimum per file of one number a record (ordinal and format); every format is normalized once over all its files (one
  DataFrame per format, not per file) and the results are unioned.
"""

from __future__ import annotations

import json
from typing import NamedTuple

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.text import py_strip
from chatloom.operators.normalize import Normalized, formats, load_format
from chatloom.plans.runtime import ensure_package
from chatloom.schema import QUARANTINE
from chatloom.sources import json_split
from chatloom.sources.tables import conform

RECORD_COLS = ["file_path", "ordinal", "line", "value", "_v", "valid"]   # shape of a records frame


class ScanResult(NamedTuple):
    samples: DataFrame
    quarantine: DataFrame
    files: DataFrame          # (file_path, format, status)
    records: DataFrame | None = None   # the persisted records; ``release()`` frees them

    def release(self) -> None:
        if self.records is not None:
            self.records.unpersist()


# -- listing -----------------------------------------------------------------------------------------
def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, suffix) of every regular file under ``path`` (recursive).  Missing path raises."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return df.select(F.col("path").alias("file_path"),
                     F.lower(F.regexp_extract("path", r"(\.[^./\\]*)$", 1)).alias("suffix"))


# case-insensitive suffix globs (Hadoop glob character classes); no file list on the driver
GLOBS = {"jsonl": "*.[jJ][sS][oO][nN][lL]", "json": "*.[jJ][sS][oO][nN]", "txt": "*.[tT][xX][tT]"}


def _text(spark: SparkSession, paths, glob: str | None, wholetext: bool = False) -> DataFrame:
    r = spark.read
    if glob:
        r = r.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if isinstance(paths, str):
        paths = [paths]
    return r.text(paths, wholetext=wholetext)


# -- strict JSON check (Python json semantics: trailing garbage is an error) --------------------------
@F.pandas_udf(T.BooleanType())
def strict_json_valid(s: pd.Series) -> pd.Series:
    def ok(x):
        if x is None:
            return False
        try:
            json.loads(x)
            return True
        except ValueError:
            return False
    return s.map(ok)


# -- A3 JSON lines ------------------------------------------------------------------------------------
def read_jsonl(spark: SparkSession, paths, strict: bool = False, glob: str | None = None) -> DataFrame:
    """A3 + A7: (file_path, ordinal, line, value, valid) for every non-blank line.

    ``ordinal`` is the 0-based index among the non-blank lines of the file and
    ``line`` the 1-based physical line number, both exact across file splits.
    """
    raw = _text(spark, paths, glob).select(
        "value", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"))
    return line_records(raw, strict)


def line_records(raw: DataFrame, strict: bool = False) -> DataFrame:
    """A3 + A7 records of lines ``(file_path, block, value)``, each split read in order by one task (also a stream's micro-batch)."""
    # numbering within a split: monotonically_increasing_id is contiguous per partition and a split is read in
    # order by one task; both passes see the same splits, as they scan the same files under the same settings (checked below)
    raw = raw.select("file_path", "block", py_strip("value").alias("value")).withColumn("_all", F.monotonically_increasing_id())
    nb = raw.where(F.col("value") != "").withColumn("_nb", F.monotonically_increasing_id())
    splits = raw.groupBy("file_path", "block").agg(
        F.min("_all").alias("all0"), F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("value") != "").alias("n_nb"))
    before = (Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file_path").orderBy("block").rowsBetween(*before)
    in_task = Window.partitionBy(F.shiftright("all0", 33)).orderBy("all0").rowsBetween(*before)
    zero = F.lit(0)
    offs = splits.select(
        "file_path", "block", "all0", "n_all",
        (F.shiftleft(F.shiftright("all0", 33), 33) + F.coalesce(F.sum("n_nb").over(in_task), zero)).alias("nb0"),
        F.coalesce(F.sum("n_all").over(in_file), zero).alias("all_before"),
        F.coalesce(F.sum("n_nb").over(in_file), zero).alias("nb_before"))
    # both passes must cut the files alike: a line that lies outside the split it was counted in is an error, no wrong number
    place = F.col("_all") - F.col("all0")
    alike = (place >= 0) & (place < F.col("n_all"))
    wrong = F.raise_error(F.lit("a file was split otherwise when its lines were counted; read it again")).cast("long")
    rec = nb.join(offs, ["file_path", "block"], "left").select(
        "file_path",
        F.when(alike, F.col("_nb") - F.col("nb0") + F.col("nb_before")).otherwise(wrong).alias("ordinal"),
        (place + F.col("all_before") + 1).alias("line"),
        "value")
    return _with_validity(rec, strict)


def _with_validity(rec: DataFrame, strict: bool) -> DataFrame:
    """Adds the record's one parse ``_v`` (VARIANT, reused by the normalizers) and ``valid``."""
    rec = rec.withColumn("_v", F.try_parse_json("value"))
    # a record beyond the VARIANT size limit is still valid when it is a JSON object
    lenient = F.col("_v").isNotNull() | F.json_object_keys("value").isNotNull()
    valid = strict_json_valid("value") if strict else lenient
    return rec.withColumn("valid", valid)


# -- A4 JSON documents ---------------------------------------------------------------------------
def read_json_document(spark: SparkSession, paths, strict: bool = False, glob: str | None = None) -> DataFrame:
    """A4 (+A5 sniffing): array -> items, object -> one item, scalar -> {"_data": x}; anything else is read as JSON lines.

    Documents are read in splits (``json_split``), so an array or a file of lines may have any size; a single record
    has to fit in memory.
    """
    return _with_validity(json_split.document_items(json_split.scan_pieces(spark, paths, glob)), strict)


def _document_kernel(batches):
    import pyarrow as pa
    names = ["file_path", "ordinal", "line", "value"]
    for b in batches:
        for path, text in zip(b.column(0), b.column(1)):
            held, size = [], 0
            for rec in json_split.text_records(text.as_py() or ""):
                held.append(rec)
                size += len(rec[2])
                if size > 8 << 20:  # a large array leaves in bounded batches
                    yield _document_batch(pa, path, held, names)
                    held, size = [], 0
            if held:
                yield _document_batch(pa, path, held, names)


def _document_batch(pa, path, rows, names):
    o, ln, v = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(rows), pa.string()), pa.array(o, pa.int64()),
                                       pa.array(ln, pa.int64()), pa.array(v, pa.string())], names=names)


def json_documents(docs: DataFrame, strict: bool = False) -> DataFrame:
    """A4 records of whole files ``(file_path, value)``, one row per file (a stream's micro-batch), by the same rules."""
    ensure_package(docs.sparkSession)
    rec = docs.select("file_path", "value").mapInArrow(_document_kernel, "file_path string, ordinal long, line long, value string")
    return _with_validity(rec, strict)


def read_records(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """A5: suffix dispatch for one file or directory of one kind."""
    p = path.lower()
    if p.endswith(".jsonl"):
        return read_jsonl(spark, path, strict)
    if p.endswith(".json"):
        return read_json_document(spark, path, strict)
    raise ValueError(f"unknown format: {path}")


# -- A6 text files ----------------------------------------------------------------------------------------
def read_text_files(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """Each file is one ``pretrain`` sample; ``source`` is the full path."""
    return text_file_samples(_text(spark, paths, glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), "value"))


def text_file_samples(files: DataFrame) -> DataFrame:
    """A6 samples of whole files ``(file_path, value)`` (also a stream's micro-batch)."""
    df = files.select("file_path", F.regexp_replace("value", "\r\n?", "\n").alias("text"))
    return conform(df.select(
        F.sha2(F.concat_ws(":", "file_path", F.lit("0")), 256).alias("sample_id"),
        F.lit("text").alias("kind"), "text", F.col("file_path").alias("source"), "file_path",
        F.lit(0).cast("long").alias("ordinal"), F.lit("pretrain").alias("type"), F.lit("txt").alias("format")))


# -- A2 detection -------------------------------------------------------------------------------------------
def detect_formats(records: DataFrame) -> DataFrame:
    """A2: (file_path, format) from the keys of each file's first valid record (registry precedence).

    One number a record, its ordinal and the place of its format in the registry: the least of each file is a hash
    aggregate with map-side partials, and no record's text moves.
    """
    specs = [s for s in formats().values() if s.detect is not None]
    if len(specs) > 254:
        raise ValueError("at most 254 formats can be detected")
    keys = F.json_object_keys("value")
    place = F.lit(len(specs)).cast("long")
    for i in range(len(specs) - 1, -1, -1):
        place = F.when(specs[i].detect(keys), F.lit(i)).otherwise(place)
    first = records.where("valid").groupBy("file_path").agg(F.min(F.shiftleft("ordinal", 8) + place).alias("_first"))
    names = F.array(*[F.lit(s.name) for s in specs], F.lit("json"))
    return first.select("file_path", F.element_at(names, (F.col("_first").bitwiseAND(255) + 1).cast("int")).alias("format"))


def records_quarantine(records: DataFrame) -> DataFrame:
    return records.where(~F.col("valid")).select(
        "file_path", "ordinal", F.col("value").alias("raw"), F.lit("bad_json").alias("reason"))


def scan_directory(spark: SparkSession, path: str, strict: bool = False) -> ScanResult:
    """A1: recurse ``path``; load txt / jsonl / json files by detected format; report the rest.

    Three glob-filtered recursive scans (no driver-side file list); each
    registered format is normalized once over all of its files.
    """
    files = list_files(spark, path)            # raises on a missing path; also feeds the report
    # the input is read once: every format's normalizer and the quarantine consume these persisted records (spilled
    # to disk when large; recomputed if an executor is lost).  Their parse is not held: it is as large as the text and
    # made again for the one format that a record has
    raw = read_jsonl(spark, path, strict, GLOBS["jsonl"]).unionByName(read_json_document(spark, path, strict, GLOBS["json"]))
    records = raw.drop("_v").persist(StorageLevel.MEMORY_AND_DISK)
    # per-file format attached by a join (AQE broadcasts the file table when it is small)
    tagged = records.where("valid").select("file_path", "ordinal", "value").join(detect_formats(records), "file_path") \
        .withColumn("_v", F.try_parse_json("value"))
    samples, quar = [], [records_quarantine(records)]
    for name, spec in formats().items():
        if spec.normalize is None:
            continue
        n: Normalized = load_format(tagged.where(F.col("format") == name).drop("format"), name)
        samples.append(n.samples)
        quar.append(n.quarantine)
    samples.append(read_text_files(spark, path, GLOBS["txt"]))
    out_s = samples[0]
    for x in samples[1:]:
        out_s = out_s.unionByName(x)
    out_q = quar[0].select(*QUARANTINE.names)
    for q in quar[1:]:
        out_q = out_q.unionByName(q.select(*QUARANTINE.names))
    loadable = [n for n, sp in formats().items() if sp.normalize is not None] + ["txt"]
    fmt_col = F.when(F.col("suffix") == ".txt", F.lit("txt")) \
        .when(F.col("suffix").isin(".json", ".jsonl"), F.coalesce("format", F.lit("unknown"))) \
        .otherwise(F.lit("unknown"))
    # the report reads the input for itself: whoever wants formats alone has no record held
    report = files.join(detect_formats(raw), "file_path", "left").select("file_path", fmt_col.alias("format")).select(
        "file_path", "format",
        F.when(F.col("format").isin(*loadable), F.lit("loaded")).otherwise(F.lit("skipped")).alias("status"))
    return ScanResult(out_s, out_q, report, records)
