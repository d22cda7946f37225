"""The corpus operators as queries over their whole tables, with oracles where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import (decontaminate, filter_audit, lang_id, lexical_search, license_scan, mixing, quote_links, simhash,
                          span_dedup, token_count, url_filter, vector_dedup, warc)
from chatloom.session import work_dir

URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
             ("net/fr/", "block")]
TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_url_filter(spark, d):
    return url_filter.judge(table(spark, d, "pages"), URL_RULES)


def op2_token_count(spark, d):
    return token_count.count_tokens(table(spark, d, "documents"), tokenizer_path())


def op3_quote_links(spark, d):
    return quote_links.link_quotes(table(spark, d, "conversations"))


def op4_lang_id(spark, d):
    docs = table(spark, d, "documents")
    return lang_id.identify(docs, lang_id.fit(docs))


def op5_license_scan(spark, d):
    return license_scan.scan(table(spark, d, "documents"))


def op6_decontaminate(spark, d):
    return decontaminate.find_items(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op7_mix_sources(spark, d):
    return mixing.mix(table(spark, d, "documents")).drop("source")


def op8_span_dedup(spark, d):
    return span_dedup.remove_repeats(table(spark, d, "documents"), keep=["doc_id", "text"])


def op9_simhash(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


def op10_vector_dedup(spark, d):
    return vector_dedup.near_duplicates(table(spark, d, "embeddings"))


def op11_lexical_search(spark, d):
    return lexical_search.search(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op12_warc_archives(spark, d):
    return warc.write_archives(table(spark, d, "pages"), work_dir(spark, "warc")).drop("url")


def op13_filter_audit(spark, d):
    return filter_audit.audit(table(spark, d, "documents"), table(spark, d, "labels"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_token_count, op3_quote_links, op4_lang_id, op5_license_scan,
                                   op6_decontaminate, op7_mix_sources, op8_span_dedup, op9_simhash, op10_vector_dedup,
                                   op11_lexical_search, op12_warc_archives, op13_filter_audit)}

OP7_SQL = r"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w
  FROM s GROUP BY source),
ranked AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, row_number() OVER (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST) AS no FROM per),
filled AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS room,
    sum(w) OVER (ORDER BY no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM ranked),
edge AS (SELECT no, room, rest FROM filled WHERE NOT room * w >= cap * rest ORDER BY no LIMIT 1),
targets AS (
  SELECT f.source, f.source_size, CASE WHEN e.no IS NULL OR f.no < e.no THEN f.cap ELSE e.room * f.w / e.rest END AS target
  FROM filled f LEFT JOIN edge e ON true),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS passes,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(passes * size + least(size, greatest(0, CAST(floor(target) AS BIGINT) - passes * source_size - before)) AS BIGINT) AS taken
FROM placed
"""

_ALONE = "".join(f"\\x{{{ord(r[0]):X}}}-\\x{{{ord(r[2]):X}}}" for r in span_dedup.ALONE)
_STOPS = "".join(span_dedup.STOPS)

OP8_SQL = rf"""
WITH cutup AS (
  SELECT doc_id, text, regexp_extract(text, '^[\x20\x09-\x0D]*') AS lead,
    regexp_extract_all(text, '(?:[{_ALONE}]|[^\x20\x09-\x0D{_ALONE}]+)[\x20\x09-\x0D]*') AS ps FROM documents),
pieces AS (
  SELECT doc_id, i, ps[i] AS piece, translate(regexp_replace(ps[i], '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM cutup)),
sent AS (
  SELECT *, coalesce(sum(CASE WHEN regexp_matches(w, '[{_STOPS}]$') OR contains(piece, chr(10)) THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sno,
    CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) AS h FROM pieces),
marked AS (
  SELECT *, CASE WHEN count(*) OVER (PARTITION BY doc_id, sno) > 12
      AND h < coalesce(min(h) OVER (PARTITION BY doc_id, sno ORDER BY i ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 4294967296)
      AND h <= coalesce(min(h) OVER (PARTITION BY doc_id, sno ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), 4294967296) THEN 1 ELSE 0 END AS cut FROM sent),
parts AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id, sno ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM marked),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id, sno, part ORDER BY i) - 1 AS pos FROM parts),
numbered AS (SELECT *, sum(CASE WHEN pos % 12 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS u FROM placed),
units AS (SELECT doc_id, u, min(i) AS s, max(i) AS e FROM numbered GROUP BY doc_id, u),
reached AS (
  SELECT a.doc_id, a.u, a.s, greatest(a.u + 2, n.u) AS k FROM units a JOIN numbered n ON n.doc_id = a.doc_id AND n.i = a.s + 29),
words AS (SELECT doc_id, list(w ORDER BY i) AS ws FROM numbered GROUP BY doc_id),
spans AS (
  SELECT r.doc_id, r.u, r.k, array_to_string(list_slice(ws, r.s, z.e), ' ') AS span
  FROM reached r JOIN units z ON z.doc_id = r.doc_id AND z.u = r.k JOIN words w ON w.doc_id = r.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY span ORDER BY doc_id, u) AS no FROM spans),
lost AS (SELECT DISTINCT doc_id, unnest(range(CAST(u AS BIGINT), CAST(k + 1 AS BIGINT))) AS u FROM ranked WHERE no > 1),
done AS (
  SELECT n.doc_id, string_agg(n.piece, '' ORDER BY n.i) FILTER (WHERE l.u IS NULL) AS text,
    count(DISTINCT n.u) AS n_sentences, count(DISTINCT l.u) AS n_removed
  FROM numbered n LEFT JOIN lost l ON n.doc_id = l.doc_id AND n.u = l.u GROUP BY n.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE d.lead || coalesce(o.text, '') END AS text,
  coalesce(o.n_sentences, 0) AS n_sentences, coalesce(o.n_removed, 0) AS n_removed
FROM cutup d LEFT JOIN done o ON d.doc_id = o.doc_id
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11_SQL = f"""
WITH dt AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
docs AS (SELECT doc_id, len(ts) AS n, ts FROM dt WHERE len(ts) > 0),
total AS (SELECT count(*) AS N, CAST(sum(n) AS BIGINT) AS L FROM docs),
it AS (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark),
qt AS (SELECT item_id, t, count(*) AS times FROM it GROUP BY item_id, t),
words AS (SELECT doc_id, n, unnest(ts) AS t FROM docs),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM words WHERE t IN (SELECT t FROM qt) GROUP BY doc_id, n, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(total.N) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM tf, total GROUP BY t),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 75 + ((75 * tf.n * total.N) // total.L))))) AS BIGINT) AS score
  FROM qt JOIN tf USING (t) JOIN w USING (t), total GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

OP12_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, html, octet_length(encode(html)) AS n, sha1(html) AS x, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(x, 1 + 10 * (k // 8), 10) AS BIGINT) >> CAST(35 - 5 * (k % 8) AS INTEGER)) & 31 AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
"""

OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
j AS (
  SELECT w.doc_id, part, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic,
    [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
     regexp_matches(text, '[#$%&*|]'), w.doc_id > first] AS fails
  FROM w LEFT JOIN labels l ON w.doc_id = l.doc_id),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM j GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.f <> b.f AND a.f <> c.f AND a.f <> d.f AND a.f <> e.f AND b.f <> c.f AND b.f <> d.f AND b.f <> e.f AND c.f <> d.f AND c.f <> e.f AND d.f <> e.f),
steps AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders),
seen AS (
  SELECT part, filter_order, step, n, good, toxic, substr(filter_order, step, 1) AS f, fails[ascii(substr(filter_order, step, 1)) - 64] AS hit,
    len(list_filter(range(1, step), lambda k: fails[ascii(substr(filter_order, CAST(k AS INTEGER), 1)) - 64])) AS before, len(list_filter(fails, lambda x: x)) AS all_fails
  FROM cells, steps),
sums AS (
  SELECT part, filter_order, step, any_value(f) AS f, CAST(coalesce(sum(n) FILTER (WHERE before = 0 AND NOT hit), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (WHERE before = 0 AND hit), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (WHERE before > 0 AND hit), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (WHERE hit AND all_fails = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (WHERE before = 0 AND hit), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (WHERE before = 0 AND hit), 0) AS BIGINT) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM sums
"""

ORACLES = {"op5_license_scan": license_scan.oracle_sql(), "op7_mix_sources": OP7_SQL, "op8_span_dedup": OP8_SQL,
           "op11_lexical_search": OP11_SQL, "op12_warc_archives": OP12_SQL, "op13_filter_audit": OP13_SQL}
