"""Licence scan: canonical digests of entire texts and of each line, hash-joined to known licence digests."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import prepare
from chatloom.llm.license_texts import DIGESTS, LICENSES, NOTICES, TITLES

# fixed values: spellings that licence matching treats as equal
SPELLINGS = [("licence", "license"), ("acknowledgement", "acknowledgment"), ("authoris", "authoriz"), ("organis", "organiz"),
             ("recognis", "recogniz"), ("favour", "favor"), ("behaviour", "behavior"), ("judgement", "judgment"),
             ("whilst", "while"), ("non-infringement", "noninfringement"), ("per cent", "percent")]
# fixed values: dashes, quotes, blanks and signs beyond ASCII that stand for ASCII punctuation
FOLDED = "\u00a0\u00ab\u00ad\u00b7\u00bb\u2002\u2003\u2009\u2010\u2011\u2012\u2013\u2014\u2015\u2018\u2019\u201a\u201b\u201c\u201d\u201e\u201f\u2022\u2026\u202f\u2039\u203a\u2212\u3000\ufeff"
COPYRIGHT_LINE = r"^[^0-9a-z©]*(copyright (\(c\)|[^a-z])*[0-9]|copyright ©|©|\(c\)|all rights reserved)"
HEAD = 10  # lines in which a holder's line needs no year (behind them stand terms, and examples of how to apply them)
HOLDER_LINE = r"^[^0-9A-Za-z©]*([Cc]opyright|COPYRIGHT):? *(\([Cc]\)|[<\[]|[Bb]y |[A-Z])"
TERMS_LINE = r"^[^0-9A-Za-z©]*(Copyright|COPYRIGHT) (Notice|Holder|Owner|Licen|Law|Act|And|Or|In|NOTICE|HOLDER|OWNER|LICEN|LAW|ACT|AND|OR|IN)"
MAX_KNOWN = 100_000  # known digests that are broadcast
_COPYRIGHT, _HOLDER, _TERMS = re.compile(COPYRIGHT_LINE), re.compile(HOLDER_LINE), re.compile(TERMS_LINE)
_FOLD = re.compile("[" + FOLDED + "]")
_MARKS = (b"copyright", b"\xc2\xa9", b"(c)", b"all rights")
_BLANK = bytes(c if 0x80 <= c or chr(c).isalnum() else 0x20 for c in range(256))


def canonical_lines(text: str | None) -> list[bytes]:
    """The lines in canonical form: A-Z lower-cased, equal spellings, punctuation and blanks as single blanks.

    Dashes, quotation marks and blanks beyond ASCII (``FOLDED``) count as punctuation.  Copyright lines, in the first
    ``HEAD`` lines also those without a year, and lines without a word are left out.
    """
    text = (text or "").replace("\r", "\n")
    if not text.isascii():
        text = _FOLD.sub(" ", text)
    head = text.split("\n", HEAD)[:HEAD]
    holders = {i for i, line in enumerate(head) if _HOLDER.match(line) and not _TERMS.match(line)}
    low = text.encode("utf-8").lower()
    for a, b in SPELLINGS:
        low = low.replace(a.encode(), b.encode())
    out = []
    for i, line in enumerate(low.split(b"\n")):
        if i in holders or (any(mark in line for mark in _MARKS) and _COPYRIGHT.match(line.decode("utf-8"))):
            continue
        words = line.translate(_BLANK).split()
        if words:
            out.append(b" ".join(words))
    return out


def digest(text: str | None) -> str | None:
    """Canonical digest of an entire text; null if it has no word."""
    lines = canonical_lines(text)
    return hashlib.md5(b" ".join(lines)).hexdigest() if lines else None


def known_digests(licenses: dict[str, str] = LICENSES, notices: dict[str, list[str]] = NOTICES) -> list[tuple[str, str]]:
    """``(digest, license_id)`` of known entire texts: licences and one-line notices."""
    rows = {(digest(t), k) for k, t in licenses.items()} | {(digest(t), k) for k, ts in notices.items() for t in ts}
    return sorted(r for r in rows if r[0])


def variants(license_id: str, text: str) -> list[str]:
    """The text with and without a usual title, also with bullets for numbers, and with the other scheme of its address."""
    bodies = {text, re.sub(r"(?m)^\d\. ", "* ", text)}
    bodies |= {b.replace("http:", "https:") for b in bodies}
    return sorted(f"{title}\n\n{b}" for b in bodies for title in ["", *TITLES.get(license_id, [])])


def default_digests() -> list[tuple[str, str]]:
    """``(digest, license_id)`` known by default: texts in their usual forms, notices and texts known by digest alone."""
    forms = {(digest(v), k) for k, t in LICENSES.items() for v in variants(k, t)}
    return sorted(forms | set(known_digests()) | {(d, k) for k, ds in DIGESTS.items() for d in ds})


def _kernel(batches):
    import pyarrow as pa
    for b in batches:
        docs, whole, digests = [], [], []
        for doc, t in zip(b.column(0).to_pylist(), b.column(1)):
            lines = canonical_lines(t.as_py())
            if lines:
                every = [(True, b" ".join(lines)), *((False, x) for x in set(lines))]
                docs += [doc] * len(every)
                whole += [w for w, _ in every]
                digests += [hashlib.md5(x).hexdigest() for _, x in every]
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(whole, pa.bool_()), pa.array(digests, pa.string())],
                                         names=["doc", "whole", "digest"])


def scan(docs: DataFrame, known: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text",
         further: DataFrame | None = None) -> DataFrame:
    """One row per input row: ``(doc_id, license_text, license_notices)``.

    ``license_text``: the licence whose entire text the whole document is, copyright lines aside (the first by name
    if several ids share a digest).  ``license_notices``: the distinct licences that a whole line of it states, sorted
    and joined by commas.  Both null without a match, so for null and empty texts.  Rows that repeat an id get the
    findings of all of them; rows without an id find nothing.  ``known``: at most ``MAX_KNOWN`` ``(digest, license_id)``
    pairs (by default ``default_digests()``), which is what makes the table safe to broadcast.  ``further``: a table of
    more ``(digest, license_id)`` rows, of any size, whose digests ``digest`` makes of whole texts or lines.  Extra columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = default_digests() if known is None else known
    if len(known) > MAX_KNOWN:
        raise ValueError(f"at most {MAX_KNOWN} known digests")
    table = F.broadcast(spark.createDataFrame(known, "digest string, license_id string"))
    if further is not None:  # without a hint: broadcast if it is small, shuffled if not
        more = further.select(F.col("digest").cast("string").alias("digest"), F.col("license_id").cast("string").alias("license_id"))
        table = spark.createDataFrame(known, "digest string, license_id string").unionByName(more).distinct()
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = src.where("doc_id is not null").mapInArrow(_kernel, "doc long, whole boolean, digest string") \
        .join(table, "digest") \
        .groupBy("doc").agg(F.min(F.when(F.col("whole"), F.col("license_id"))).alias("license_text"),
                            F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license_id")))).alias("_notices")) \
        .select("doc", "license_text", F.when(F.size("_notices") > 0, F.array_join("_notices", ",")).alias("license_notices"))
    return src.select("doc_id").join(found, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "license_text", "license_notices")


ORACLE_SQL = """
WITH known(digest, license_id) AS (VALUES {known}),
raw AS (SELECT doc_id, string_split(replace(regexp_replace(coalesce(text, ''), '[{folded}]', ' ', 'g'), chr(13), chr(10)), chr(10)) AS r
  FROM documents),
left_in AS (SELECT doc_id, [x FOR x IN r[1:{head}] IF NOT regexp_matches(x, '{holder}') OR regexp_matches(x, '{terms}')] || r[{head} + 1:] AS r FROM raw),
low AS (SELECT doc_id, [{spelled} FOR y IN r] AS r FROM left_in),
lines AS (SELECT doc_id, [l FOR l IN [
    trim(regexp_replace(x, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')) FOR x IN r
      IF NOT regexp_matches(x, '{copyright}')] IF l <> ''] AS ls FROM low),
found AS (
  SELECT doc_id, true AS whole, md5(array_to_string(ls, ' ')) AS digest FROM lines WHERE len(ls) > 0
  UNION ALL
  SELECT doc_id, false, md5(l) FROM (SELECT doc_id, unnest(ls) AS l FROM lines)),
named AS (SELECT doc_id, min(license_id) FILTER (WHERE whole) AS license_text,
    string_agg(DISTINCT license_id, ',' ORDER BY license_id) FILTER (WHERE NOT whole) AS license_notices
  FROM found JOIN known USING (digest) GROUP BY doc_id)
SELECT d.doc_id, n.license_text, n.license_notices FROM documents d LEFT JOIN named n USING (doc_id)
"""


def oracle_sql() -> str:
    spelled = "translate(y, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    for a, b in SPELLINGS:
        spelled = f"replace({spelled}, '{a}', '{b}')"
    known = ", ".join(f"('{d}', '{i}')" for d, i in default_digests())
    return ORACLE_SQL.format(known=known, spelled=spelled, folded=FOLDED, head=HEAD, holder=HOLDER_LINE, terms=TERMS_LINE,
                             copyright=COPYRIGHT_LINE)
