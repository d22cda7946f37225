"""Queries for loading, normalizing, lifecycle and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import profile as P
from chatloom.operators.normalize import (
    load_format,
    normalize_alpaca,
    normalize_moss,
    normalize_sharegpt,
)
from chatloom.operators.samples import accumulate_load, clear_samples, union_samples
from chatloom.operators.vocab import load_vocab, save_vocab, turn_table_vocab
from chatloom.plans import oracle as O
from chatloom.plans.catalog import dialog_lengths, doc_samples, register
from chatloom.plans.dialects import alpaca_records, moss_records, sharegpt_records
from chatloom.session import work_dir
from chatloom.sources.tables import read_table


def _conv(spark, d):
    return read_table(spark, d, "conversations")


def dialog_md5():
    return F.md5(F.array_join(F.transform("dialog", lambda t: F.concat(t["role"], F.lit(":"), t["content"])), "\n"))


# -- oracle fragments for the three dialects ------------------------------------------------------
CONV_AGG = """conv_agg AS (
  SELECT conv_id,
         count(*) FILTER (WHERE role = 'assistant') AS n_asst,
         list(text ORDER BY turn) FILTER (WHERE role = 'system') AS sys_l,
         list(text ORDER BY turn) FILTER (WHERE role = 'user') AS usr_l,
         list(text ORDER BY turn) FILTER (WHERE role = 'assistant') AS ast_l
  FROM conversations GROUP BY conv_id
)"""

SGPT = """sgpt AS (
  SELECT 'conversations.sharegpt.jsonl' AS file_path, conv_id AS ordinal, 'sharegpt' AS format,
         'conversations.sharegpt.jsonl:' || conv_id AS source,
         (count(*) FILTER (WHERE role = 'assistant'))::BIGINT AS turns, count(*)::BIGINT AS n_msgs,
         md5(string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS dialog_md5,
         arg_min(text, turn) AS first_content
  FROM conversations GROUP BY conv_id HAVING count(*) FILTER (WHERE role = 'assistant') > 0
)"""

MOSS = """moss AS (
  SELECT 'conversations.moss.jsonl' AS file_path, conv_id AS ordinal, 'moss' AS format,
         'conversations.moss.jsonl:' || conv_id AS source, 'chat' AS category,
         (count(*) FILTER (WHERE role = 'assistant'))::BIGINT AS turns,
         (count(*) FILTER (WHERE role IN ('user', 'assistant')))::BIGINT AS n_msgs,
         md5(string_agg(role || ':' || text, chr(10) ORDER BY turn) FILTER (WHERE role IN ('user', 'assistant')))
           AS dialog_md5
  FROM conversations GROUP BY conv_id HAVING count(*) FILTER (WHERE role = 'assistant') > 0
)"""

# the e-th user and assistant turns side by side; even exchanges carry the user turn before as input
EXCHANGES = """exch AS (
  SELECT conv_id, sys_l[1] AS sys, usr_l[e] AS ins, CASE WHEN e % 2 = 0 THEN usr_l[e - 1] END AS inp, ast_l[e] AS out, e
  FROM (SELECT *, unnest(range(1, greatest(coalesce(len(usr_l), 0), coalesce(len(ast_l), 0), 1) + 1)) AS e FROM conv_agg)
)"""

ALPACA = EXCHANGES + """,
alpaca AS (
  SELECT 'conversations.alpaca.' || e || '.jsonl' AS file_path, conv_id AS ordinal, 'alpaca' AS format,
         'conversations.alpaca.' || e || '.jsonl:' || conv_id AS source,
         (CASE WHEN coalesce(sys, '') <> '' THEN 3 ELSE 2 END)::BIGINT AS n_msgs,
         md5(concat_ws(chr(10), CASE WHEN coalesce(sys, '') <> '' THEN 'system:' || sys END,
                       'user:' || CASE WHEN coalesce(inp, '') <> '' THEN ins || chr(10) || inp ELSE ins END,
                       'assistant:' || out)) AS dialog_md5
  FROM exch WHERE ins IS NOT NULL AND out IS NOT NULL
)"""

QUAR = """quar AS (
  SELECT 'conversations.sharegpt.jsonl' AS file_path, conv_id::BIGINT AS ordinal, 'no_assistant' AS reason
  FROM conv_agg WHERE n_asst = 0
  UNION ALL
  SELECT 'conversations.moss.jsonl', conv_id, 'no_assistant' FROM conv_agg WHERE n_asst = 0
  UNION ALL
  SELECT 'conversations.alpaca.' || e || '.jsonl', conv_id, 'null_content' FROM exch
  WHERE ins IS NULL OR out IS NULL
)"""


def _all_dialects(spark, d):
    c = _conv(spark, d)
    return (normalize_sharegpt(sharegpt_records(c)), normalize_moss(moss_records(c)),
            normalize_alpaca(alpaca_records(c)))


# -- B1–B5 ------------------------------------------------------------------------------------------
@register("normalize_moss", O.with_(MOSS) + "SELECT source, category, turns, n_msgs, dialog_md5 FROM moss")
def q_normalize_moss(spark, d):
    s = normalize_moss(moss_records(_conv(spark, d))).samples
    return s.select("source", "category", F.col("turns").cast("long"), F.size("dialog").cast("long").alias("n_msgs"),
                    dialog_md5().alias("dialog_md5"))


@register("normalize_sharegpt", O.with_(SGPT) + "SELECT source, turns, n_msgs, dialog_md5 FROM sgpt")
def q_normalize_sharegpt(spark, d):
    s = normalize_sharegpt(sharegpt_records(_conv(spark, d))).samples
    return s.select("source", F.col("turns").cast("long"), F.size("dialog").cast("long").alias("n_msgs"),
                    dialog_md5().alias("dialog_md5"))


@register("normalize_alpaca", O.with_(CONV_AGG, ALPACA) + "SELECT source, n_msgs, dialog_md5 FROM alpaca")
def q_normalize_alpaca(spark, d):
    s = normalize_alpaca(alpaca_records(_conv(spark, d))).samples
    return s.select("source", F.size("dialog").cast("long").alias("n_msgs"), dialog_md5().alias("dialog_md5"))


@register("load_format", O.with_(CONV_AGG, SGPT, MOSS, ALPACA) + """
SELECT format, source FROM sgpt UNION ALL SELECT format, source FROM moss UNION ALL SELECT format, source FROM alpaca""")
def q_load_format(spark, d):
    c = _conv(spark, d)
    parts = [load_format(sharegpt_records(c), "sharegpt").samples, load_format(moss_records(c), "moss").samples,
             load_format(alpaca_records(c), "alpaca").samples]
    return union_samples(*parts).select("format", "source")


@register("quarantine", O.with_(CONV_AGG, EXCHANGES, QUAR) + "SELECT file_path, ordinal, reason FROM quar")
def q_quarantine(spark, d):
    qs = [n.quarantine for n in _all_dialects(spark, d)]
    out = qs[0].unionByName(qs[1]).unionByName(qs[2])
    return out.select("file_path", "ordinal", "reason")


# -- C1–C3 -----------------------------------------------------------------------------------------------
UNION_SQL = O.with_(CONV_AGG, SGPT, MOSS, ALPACA) + """,
docs AS (SELECT 'documents' AS file_path, doc_id AS ordinal, 'table' AS format, 'documents:' || doc_id AS source,
                'pretrain' AS type, text FROM documents),
u AS (
  SELECT file_path, ordinal, format, source, 'sft' AS type, 'dialog' AS kind, turns FROM sgpt
  UNION ALL SELECT file_path, ordinal, format, source, 'sft', 'dialog', turns FROM moss
  UNION ALL SELECT file_path, ordinal, format, source, 'sft', 'dialog', NULL FROM alpaca
  UNION ALL SELECT file_path, ordinal, format, source, type, 'text', NULL FROM docs
)
"""


def _union(spark, d):
    n = _all_dialects(spark, d)
    return union_samples(n[0].samples, n[1].samples, n[2].samples, doc_samples(spark, d))


@register("union_samples", UNION_SQL + "SELECT format, source, kind FROM u")
def q_union_samples(spark, d):
    return _union(spark, d).select("format", "source", "kind")


@register("accumulate_load", O.with_(CONV_AGG, SGPT, MOSS) + """,
loads AS (SELECT 1 AS load_no, count(*) AS added FROM sgpt UNION ALL SELECT 2, count(*) FROM moss)
SELECT load_no, added::BIGINT AS added, (sum(added) OVER (ORDER BY load_no))::BIGINT AS total FROM loads""")
def q_accumulate_load(spark, d):
    c = _conv(spark, d)
    path = work_dir(spark, "samples") + "/samples"
    accumulate_load(normalize_sharegpt(sharegpt_records(c)).samples, path, 1)
    rep = accumulate_load(normalize_moss(moss_records(c)).samples, path, 2)
    return rep.select(F.col("load_no").cast("int"), F.col("added").cast("long"), F.col("total").cast("long"))


@register("clear_samples", O.with_(SGPT) + """
SELECT 'before' AS state, count(*)::BIGINT AS n_samples, count(DISTINCT dialog_md5)::BIGINT AS n_texts FROM sgpt
UNION ALL SELECT 'after', count(*)::BIGINT, count(DISTINCT dialog_md5)::BIGINT FROM sgpt WHERE false""")
def q_clear_samples(spark, d):
    path = work_dir(spark, "samples") + "/samples"
    accumulate_load(normalize_sharegpt(sharegpt_records(_conv(spark, d))).samples, path, 1)
    count = lambda df, state: df.agg(F.count(F.lit(1)).alias("n_samples"), F.countDistinct(dialog_md5()).alias("n_texts")) \
        .select(F.lit(state).alias("state"), "n_samples", "n_texts")
    before = count(spark.read.parquet(path), "before").checkpoint()      # counted before the table goes
    return before.unionByName(count(clear_samples(spark, path), "after"))


# -- A13 -------------------------------------------------------------------------------------------------------
@register("save_load_vocab", O.with_(O.dialog_turns(), O.dialog_vocab()) + "SELECT token, id, is_special FROM vocab")
def q_save_load_vocab(spark, d):
    path = work_dir(spark, "vocab") + "/vocab"
    save_vocab(turn_table_vocab(_conv(spark, d)), path)
    return load_vocab(spark, path)


# -- D1–D7 -----------------------------------------------------------------------------------------------------
@register("load_stats", UNION_SQL + "SELECT format, count(*)::BIGINT AS n_samples FROM u GROUP BY format")
def q_load_stats(spark, d):
    return P.load_stats(_union(spark, d))


@register("stats_by_source", UNION_SQL + """
SELECT split_part(source, ':', 1) AS source, count(*)::BIGINT AS n_samples FROM u GROUP BY 1""")
def q_stats_by_source(spark, d):
    return P.stats_by_source(_union(spark, d))


@register("stats_by_type", UNION_SQL + "SELECT type, count(*)::BIGINT AS n_samples FROM u GROUP BY type")
def q_stats_by_type(spark, d):
    return P.stats_by_type(_union(spark, d))


@register("sample_preview", O.with_(SGPT) + """,
docs AS (SELECT 'documents' AS file_path, doc_id AS ordinal, text AS first_content FROM documents),
u AS (SELECT file_path, ordinal, first_content FROM sgpt UNION ALL SELECT * FROM docs),
f AS (SELECT arg_min(first_content, (file_path, ordinal)) AS p, count(*) AS total FROM u)
SELECT total::BIGINT AS total, CASE WHEN length(p) > 100 THEN left(p, 100) || '...' ELSE p END AS preview FROM f""")
def q_sample_preview(spark, d):
    s = union_samples(normalize_sharegpt(sharegpt_records(_conv(spark, d))).samples, doc_samples(spark, d))
    return P.sample_preview(s)


@register("corpus_profile", O.with_(SGPT) + """,
docs AS (SELECT 'documents' AS file_path, doc_id AS ordinal, text AS first_content FROM documents),
u AS (SELECT 'sharegpt' AS format, 'conversations.sharegpt.jsonl' AS source, 'sft' AS type, 'dialog' AS kind, file_path, ordinal, first_content FROM sgpt
      UNION ALL SELECT 'table', 'documents', 'pretrain', 'text', * FROM docs),
g AS (SELECT CASE WHEN grouping(format) = 0 THEN 'format' WHEN grouping(source) = 0 THEN 'source' WHEN grouping(type) = 0 THEN 'type' ELSE 'total' END AS "by",
        coalesce(format, source, type) AS key, count(*) AS n_samples, count(*) FILTER (WHERE kind = 'dialog') AS n_dialogs,
        count(*) FILTER (WHERE kind = 'text') AS n_texts, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds,
        arg_min(first_content, (file_path, ordinal)) AS p
      FROM u GROUP BY GROUPING SETS ((format), (source), (type), ()))
SELECT "by", key, n_samples, n_dialogs, n_texts, kinds,
  CASE WHEN "by" = 'total' THEN CASE WHEN length(p) > 100 THEN left(p, 100) || '...' ELSE p END END AS preview FROM g""")
def q_corpus_profile(spark, d):
    """D1–D5 at once: one scan of the samples."""
    s = union_samples(normalize_sharegpt(sharegpt_records(_conv(spark, d))).samples, doc_samples(spark, d))
    return P.profile(s).withColumn("kinds", F.array_join("kinds", ","))


@register("corpus_composition", UNION_SQL + """
SELECT (count(*) FILTER (WHERE kind = 'dialog'))::BIGINT AS n_dialogs,
       (count(*) FILTER (WHERE kind = 'text'))::BIGINT AS n_texts FROM u""")
def q_corpus_composition(spark, d):
    return P.corpus_composition(_union(spark, d))


@register("training_plan", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids()) + f""",
lens AS (SELECT sample_id, count(*) AS L FROM ids GROUP BY sample_id),
nw AS (SELECT sum(CASE WHEN L <= {O.S + 1} THEN 1 ELSE ceil((L - {O.S}) / {O.STRIDE}) END)::BIGINT AS n FROM lens)
SELECT n AS n_windows, ceil(n / 8)::BIGINT AS batches, (ceil(n / 8) * 12)::BIGINT AS steps FROM nw""")
def q_training_plan(spark, d):
    return P.plan_of_lengths(dialog_lengths(spark, d), O.S, O.STRIDE, batch_size=8, epochs=12)


@register("turn_totals", O.with_(CONV_AGG, SGPT, MOSS, ALPACA) + """
SELECT file_path, count(*)::BIGINT AS n_samples, sum(turns)::BIGINT AS turn_total FROM
  (SELECT file_path, turns FROM sgpt UNION ALL SELECT file_path, turns FROM moss
   UNION ALL SELECT file_path, 1 FROM alpaca) GROUP BY file_path""")
def q_turn_totals(spark, d):
    n = _all_dialects(spark, d)
    return P.turn_totals(union_samples(n[0].samples, n[1].samples, n[2].samples))


# -- K1 --------------------------------------------------------------------------------------------------------
def normalize_pairs(records):
    """A user-registered dialect: {"prompt": ..., "response": ...} -> one user/assistant exchange."""
    from chatloom.operators.normalize import Normalized, _split
    keys = F.json_object_keys("value")
    p, r = F.get_json_object("value", "$.prompt"), F.get_json_object("value", "$.response")
    dialog = F.array(F.struct(F.lit("user").alias("role"), p.alias("content")),
                     F.struct(F.lit("assistant").alias("role"), r.alias("content")))
    df = records.select("file_path", "ordinal", "value", keys.alias("_keys"), dialog.alias("dialog"))
    reason = F.when(F.col("_keys").isNull(), F.lit("bad_json")) \
        .when(p.isNull() | r.isNull(), F.lit("null_content"))
    out: Normalized = _split(df, reason, [F.lit("dialog").alias("kind"), "dialog", F.lit("sft").alias("type"),
                                          F.lit(1).alias("turns"), F.lit("pairs").alias("format")])
    return out


@register("register_format", O.with_(CONV_AGG, EXCHANGES) + """
SELECT conv_id AS ordinal, e::INTEGER AS exchange, md5('user:' || ins || chr(10) || 'assistant:' || out) AS dialog_md5
FROM exch WHERE ins IS NOT NULL AND out IS NOT NULL""")
def q_register_format(spark, d):
    from chatloom.operators.normalize import _has, formats, register_format, unregister_format
    from chatloom.plans.dialects import exchanges
    added = "pairs" not in formats()
    if added:
        register_format("pairs", lambda k: _has(k, "prompt"), normalize_pairs)
    items = exchanges(_conv(spark, d)).select(
        F.concat(F.lit("conversations.pairs."), F.col("e").cast("string"), F.lit(".jsonl")).alias("file_path"),
        F.col("conv_id").cast("long").alias("ordinal"),
        F.to_json(F.struct(F.col("user").alias("prompt"), F.col("assistant").alias("response"))).alias("value"))
    try:
        s = load_format(items, "pairs").samples      # the plan is built here; the registry is not needed later
    finally:
        if added:
            unregister_format("pairs")
    e = F.regexp_extract("file_path", r"pairs\.(\d+)\.jsonl", 1).cast("int")
    return s.select("ordinal", e.alias("exchange"), dialog_md5().alias("dialog_md5"))
