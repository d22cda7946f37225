"""Queries for file sources and sinks.

A file tree is derived by Spark from the given tables (dialect items per dialog,
document texts) and written under the shared work folder; the scanners then read
it back.  Layout-independent outputs keep the oracle comparison exact.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators.batches import dense_positions
from chatloom.plans import oracle as O
from chatloom.plans.catalog import arr_sum, dialog_windows, register
from chatloom.plans.dialects import KEEP_NULLS, alpaca_items, grouped_dialogs, moss_items, sharegpt_items
from chatloom.session import work_dir
from chatloom.sources import files as FS
from chatloom.sources.fs import remove_tree, rename_suffix
from chatloom.sources.sinks import (
    export_dataset,
    export_splits_jsonl,
    read_split_export,
    select_known_fields,
    write_windows,
)
from chatloom.sources.tables import read_table, resolve_text_column

CHUNK = 64          # records per JSON-array file / documents per text file
_TREES: dict = {}


def _sgpt(spark, dialogs, docs, path):
    # JSON lines, each file ordered by dialog id
    sharegpt_items(dialogs).sortWithinPartitions("ordinal").select(F.to_json("item").alias("value")).write.mode("overwrite").text(path)
    rename_suffix(spark, path, ".txt", ".jsonl")


def _moss(spark, dialogs, docs, path):
    # JSON writer: .json files whose content is JSON lines
    moss_items(dialogs).select("item.*").write.mode("overwrite").json(path)


def _alpaca(spark, dialogs, docs, path):
    # one JSON array per file: the exchanges of CHUNK dialogs; a chunk is one row of one task already
    arrays = alpaca_items(dialogs).groupBy((F.col("ordinal") / CHUNK).cast("long").alias("chunk")).agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "e", "item"))), lambda x: x["item"]),
                  KEEP_NULLS).alias("value"))
    arrays.write.mode("overwrite").partitionBy("chunk").text(path)
    rename_suffix(spark, path, ".txt", ".json")


def _docs(spark, dialogs, docs, path):
    # one text file per chunk of documents
    docs.select((F.col("doc_id") / CHUNK).cast("long").alias("chunk"), F.col("text").alias("value")) \
        .repartition("chunk").write.mode("overwrite").partitionBy("chunk").text(path)


def _misc(spark, dialogs, docs, path):
    docs.select("doc_id", "lang").write.mode("overwrite").option("header", True).csv(path)


DIALECTS = {"sgpt": _sgpt, "moss": _moss, "alpaca": _alpaca}
PARTS = {**DIALECTS, "docs": _docs, "misc": _misc}


def build_tree(spark, d: str, *parts: str) -> str:
    """sgpt/*.jsonl, moss/*.json (JSON lines), alpaca/chunk=*/…json (arrays), docs/chunk=*/…txt, misc/*.csv.

    The named ``parts`` (all by default) that aren't there yet are written.  Where that is several dialects, dialogs are
    put together by one shuffle of the turns, into a table that goes when the dialects are written.
    """
    root, made = _TREES.setdefault((spark.sparkContext.applicationId, d), (work_dir(spark, "tree"), set()))
    new = [p for p in parts or PARTS if p not in made]
    dialogs, docs, held = read_table(spark, d, "conversations"), read_table(spark, d, "documents"), None
    if sum(p in DIALECTS for p in new) > 1:
        held = work_dir(spark, "dialogs") + "/dialogs"
        grouped_dialogs(dialogs).write.parquet(held)
        dialogs = spark.read.parquet(held)
    for p in new:
        PARTS[p](spark, dialogs, docs, f"{root}/{p}")
        made.add(p)
    if held:
        remove_tree(spark, held)
    return root


def _dir(col):
    return F.regexp_extract(col, r"/(sgpt|moss|alpaca|docs|misc)/", 1)


def _content_chars(dialog):
    return F.aggregate(F.transform(dialog, lambda t: F.char_length(t["content"]).cast("long")),
                       F.lit(0).cast("long"), lambda a, x: a + x)


# -- A1 ----------------------------------------------------------------------------------------------
@register("scan_directory", """
WITH k AS (SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') AS n_asst,
                  list(text ORDER BY turn) FILTER (WHERE role = 'system') AS s,
                  list(text ORDER BY turn) FILTER (WHERE role = 'user') AS u,
                  list(text ORDER BY turn) FILTER (WHERE role = 'assistant') AS a,
                  sum(length(text)) AS all_chars,
                  sum(length(text)) FILTER (WHERE role IN ('user', 'assistant')) AS ua_chars
           FROM conversations GROUP BY conv_id)
SELECT 'sharegpt' AS format, count(*)::BIGINT AS n_samples, sum(all_chars)::BIGINT AS n_chars FROM k WHERE n_asst > 0
UNION ALL
SELECT 'moss', count(*)::BIGINT, sum(ua_chars)::BIGINT FROM k WHERE n_asst > 0
UNION ALL
SELECT 'alpaca', count(*)::BIGINT,
       sum(coalesce(length(s[1]), 0) + length(u[e]) + length(a[e])
           + CASE WHEN e % 2 = 0 AND coalesce(u[e - 1], '') <> '' THEN 1 + length(u[e - 1]) ELSE 0 END)::BIGINT
FROM (SELECT *, unnest(range(1, coalesce(len(u), 0) + 1)) AS e FROM k) WHERE u[e] IS NOT NULL AND a[e] IS NOT NULL
UNION ALL
SELECT 'txt', count(DISTINCT doc_id // 64)::BIGINT, sum(length(text) + 1)::BIGINT FROM documents""")
def q_scan_directory(spark, d):
    res = FS.scan_directory(spark, build_tree(spark, d))
    s = res.samples
    chars = F.when(F.col("kind") == "dialog", _content_chars(F.col("dialog"))).otherwise(F.char_length("text"))
    return s.groupBy("format").agg(F.count("*").cast("long").alias("n_samples"), F.sum(chars).cast("long").alias("n_chars"))


# -- A2 ----------------------------------------------------------------------------------------------
@register("detect_format", """
SELECT dir, format FROM (SELECT DISTINCT 1 AS one FROM conversations) c,
  (VALUES ('sgpt', 'sharegpt', 'loaded'), ('moss', 'moss', 'loaded'), ('alpaca', 'alpaca', 'loaded')) v(dir, format, status)
UNION ALL
SELECT DISTINCT 'docs', 'txt' FROM documents
UNION ALL
SELECT DISTINCT 'misc', 'unknown' FROM documents""")
def q_detect_format(spark, d):
    res = FS.scan_directory(spark, build_tree(spark, d))
    return res.files.select(_dir(F.col("file_path")).alias("dir"), "format").where(F.col("dir") != "").distinct()


# -- A3 / A7 -----------------------------------------------------------------------------------------
@register("read_jsonl", """
SELECT conv_id AS conv_id, (count(*) FILTER (WHERE role <> 'system'))::BIGINT AS n_turns,
       (count(*) FILTER (WHERE role = 'system') > 0) AS has_system, true AS ordinal_ok
FROM conversations GROUP BY conv_id""")
def q_read_jsonl(spark, d):
    root = build_tree(spark, d, "sgpt")
    r = FS.read_jsonl(spark, f"{root}/sgpt")
    item = F.from_json("value", "struct<id:long, system:string, conversations:array<struct<from:string,value:string>>>")
    r = r.select("file_path", "ordinal", item["id"].alias("conv_id"),
                 F.size(item["conversations"]).cast("long").alias("n_turns"),
                 item["system"].isNotNull().alias("has_system"))
    # each file was written ordered by dialog id: the ordinal must equal the id's rank in its file
    # (a distributed rank: one file may hold a large share of all records)
    r = dense_positions(r, ["file_path"], ["conv_id"], out_col="rank")
    return r.select("conv_id", "n_turns", "has_system", (F.col("ordinal") == F.col("rank")).alias("ordinal_ok"))


# -- A4 / A5 -----------------------------------------------------------------------------------------
@register("read_json_document", """
SELECT conv_id // 64 AS chunk, (row_number() OVER (PARTITION BY conv_id // 64 ORDER BY conv_id, e) - 1)::BIGINT AS ordinal,
       md5(coalesce(s[1], '-')) AS system_md5, md5(coalesce(u[e], '-')) AS instruction_md5,
       md5(coalesce(CASE WHEN e % 2 = 0 THEN u[e - 1] END, '-')) AS input_md5, md5(coalesce(a[e], '-')) AS output_md5
FROM (SELECT *, unnest(range(1, greatest(coalesce(len(u), 0), coalesce(len(a), 0), 1) + 1)) AS e FROM (
  SELECT conv_id, list(text ORDER BY turn) FILTER (WHERE role = 'system') AS s,
         list(text ORDER BY turn) FILTER (WHERE role = 'user') AS u,
         list(text ORDER BY turn) FILTER (WHERE role = 'assistant') AS a FROM conversations GROUP BY conv_id))""")
def q_read_json_document(spark, d):
    root = build_tree(spark, d, "alpaca")
    r = FS.read_json_document(spark, f"{root}/alpaca")
    chunk = F.regexp_extract("file_path", r"chunk=(\d+)", 1).cast("long")
    part = lambda k: F.md5(F.coalesce(F.get_json_object("value", f"$.{k}"), F.lit("-"))).alias(f"{k}_md5")
    return r.where("valid").select(chunk.alias("chunk"), "ordinal", part("system"), part("instruction"), part("input"),
                                   part("output"))


@register("read_records", """
SELECT conv_id::VARCHAR AS conversation_id, count(*)::BIGINT AS n_turn_keys FROM conversations GROUP BY conv_id""")
def q_read_records(spark, d):
    root = build_tree(spark, d, "moss")
    r = FS.read_records(spark, f"{root}/moss/*.json")
    return r.where("valid").select(
        F.get_json_object("value", "$.conversation_id").alias("conversation_id"),
        F.size(F.json_object_keys(F.get_json_object("value", "$.conversation"))).cast("long").alias("n_turn_keys"))


# -- A6 ----------------------------------------------------------------------------------------------
@register("read_text_files", """
SELECT doc_id // 64 AS chunk, sum(length(text) + 1)::BIGINT AS n_chars, 'pretrain' AS type
FROM documents GROUP BY 1""")
def q_read_text_files(spark, d):
    root = build_tree(spark, d, "docs")
    t = FS.read_text_files(spark, f"{root}/docs")
    return t.select(F.regexp_extract("file_path", r"chunk=(\d+)", 1).cast("long").alias("chunk"),
                    F.char_length("text").cast("long").alias("n_chars"), "type")


# -- A8 ----------------------------------------------------------------------------------------------
@register("resolve_text_column", """
SELECT doc_id, lang, n_chars, md5(text) AS text_md5, 'sft' AS type FROM documents WHERE coalesce(text, '') <> ''""")
def q_resolve_text_column(spark, d):
    s = resolve_text_column(read_table(spark, d, "documents"), "text", "documents")
    m = F.col("metadata")
    return s.select(F.get_json_object(m, "$.doc_id").cast("long").alias("doc_id"),
                    F.get_json_object(m, "$.lang").alias("lang"),
                    F.get_json_object(m, "$.n_chars").cast("long").alias("n_chars"),
                    F.md5("text").alias("text_md5"), "type")


@register("resolve_text_fallback", """
SELECT page_id, md5(CASE WHEN length(url) > 50 THEN url WHEN length(html) > 50 THEN html END) AS text_md5
FROM pages WHERE coalesce(CASE WHEN length(url) > 50 THEN url WHEN length(html) > 50 THEN html END, '') <> ''""")
def q_resolve_text_fallback(spark, d):
    s = resolve_text_column(read_table(spark, d, "pages"), "text", "pages")
    return s.select(F.get_json_object("metadata", "$.page_id").cast("long").alias("page_id"),
                    F.md5("text").alias("text_md5"))


# -- A9–A11 ------------------------------------------------------------------------------------------
@register("export_splits_jsonl", """
SELECT lang AS split, doc_id, md5(text) AS text_md5 FROM documents""")
def q_export_splits(spark, d):
    path = work_dir(spark, "export") + "/documents"
    docs = read_table(spark, d, "documents").withColumnRenamed("lang", "split")
    export_splits_jsonl(docs, path, "split")
    back = read_split_export(spark, path)
    return back.select(F.col("split").cast("string"), F.col("doc_id").cast("long"), F.md5("text").alias("text_md5"))


@register("export_manifest", """
SELECT 'documents' AS dataset, string_agg(lang, ',' ORDER BY lang) AS splits,
       string_agg(lang || ':' || n, ',' ORDER BY lang) AS split_counts, sum(n)::BIGINT AS total_samples, count(*)::BIGINT AS files
FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)""")
def q_export_manifest(spark, d):
    docs = read_table(spark, d, "documents").select(F.col("lang").alias("split"), "doc_id")
    back = export_dataset(docs, work_dir(spark, "dataset"), "documents")
    counts = F.transform("split_counts", lambda x: F.concat(x["split"], F.lit(":"), x["n"].cast("string")))
    return back.select("dataset", F.array_join("splits", ",").alias("splits"), F.array_join(counts, ",").alias("split_counts"),
                       "total_samples", "files")


@register("select_known_fields", "SELECT md5(text) AS text_md5 FROM documents")
def q_select_known_fields(spark, d):
    k = select_known_fields(read_table(spark, d, "documents"))
    return k.select(F.md5("text").alias("text_md5"))


# -- A12 ---------------------------------------------------------------------------------------------
@register("write_windows", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids(), O.windows()) + f"""
SELECT sample_id, window_no, (sum(id) FILTER (WHERE off < {O.S}))::BIGINT AS input_sum,
       (sum(id) FILTER (WHERE off > 0))::BIGINT AS target_sum, sum(mask)::BIGINT AS n_true
FROM win GROUP BY sample_id, window_no""")
def q_write_windows(spark, d):
    path = work_dir(spark, "windows") + "/windows"
    write_windows(dialog_windows(spark, d)[0], path, max_records_per_file=500)
    back = spark.read.parquet(path)
    return back.select("sample_id", "window_no", arr_sum("input_ids").alias("input_sum"),
                       arr_sum("target_ids").alias("target_sum"),
                       F.size(F.filter("loss_mask", lambda m: m)).cast("long").alias("n_true"))


# -- A7 ----------------------------------------------------------------------------------------------
@register("record_ordinal", """
SELECT conv_id, true AS ordinal_ok, true AS line_ok FROM (SELECT DISTINCT conv_id FROM conversations)""")
def q_record_ordinal(spark, d):
    """Ordinals and physical line numbers of the JSONL tree: files were written ordered by dialog id."""
    root = build_tree(spark, d, "sgpt")
    r = FS.read_jsonl(spark, f"{root}/sgpt").select(
        "file_path", "ordinal", "line", F.get_json_object("value", "$.id").cast("long").alias("conv_id"))
    r = dense_positions(r, ["file_path"], ["conv_id"], out_col="rank")
    return r.select("conv_id", (F.col("ordinal") == F.col("rank")).alias("ordinal_ok"),
                    (F.col("line") == F.col("ordinal") + 1).alias("line_ok"))
