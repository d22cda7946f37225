"""URL filter: host/path rules first, then a character language-model ratio for the rest.

Two variable-order Markov models (orders 0..n, interpolated Witten-Bell) learn accepted and rejected
URLs; a URL without a rule is judged by its length-normalised log-likelihood difference against a
threshold calibrated on labelled URLs that the models have not seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.charlm import MarkovPair, count_ngrams, normalise_url
from chatloom.llm.common import cut, prepare

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES = 1000  # the rules become one expression


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_expression(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest fitting rule, both null without one.

    A rule ``host/path`` fits its host and all subdomains if the path starts with the rule's path.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest ends up outermost
        h, slash, rest = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _drawn(labelled: DataFrame, max_rows: int) -> DataFrame:
    """About ``max_rows`` distinct URLs of each label, all where there are fewer.

    They are drawn by a hash of the URL at a rate from their approximate number: a filter where they are read, so no
    task holds more than its share.
    """
    sizes = labelled.groupBy("accepted").agg(F.approx_count_distinct("url_text").alias("n")).collect()
    rate = F.lit(0.0)
    for r in sizes:
        if r["accepted"] is not None:
            # the count is approximate: a label that may have no more than max_rows is taken whole
            share = 1.0 if r["n"] <= 0.8 * max_rows else max_rows / r["n"]
            rate = F.when(F.col("accepted") == r["accepted"], F.lit(share)).otherwise(rate)
    draw = F.pmod(F.xxhash64("url_text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.where(draw < rate)


def fit(labelled: DataFrame, order: int = 5, max_rows: int | None = None, calibration: int = 5) -> MarkovPair:
    """Models and threshold from ``(url_text, accepted)`` rows.

    Every distinct labelled URL is used; only a caller that names ``max_rows`` learns from a draw of about so many of
    each label.  One in ``calibration`` of them is held out; the threshold is the one that makes fewest mistakes,
    weighted so that both labels count alike.  The driver gets the distinct n-grams, not the URLs.
    """
    prepare(labelled.sparkSession)
    used = labelled.where("accepted is not null") if max_rows is None else _drawn(labelled, max_rows)
    sample = cut(used.select("url_text", "accepted").distinct()
                 .withColumn("held", F.pmod(F.xxhash64(F.lit("held"), "url_text"), F.lit(calibration)) == 0))
    counts = count_ngrams(sample.where("not held").select(F.col("accepted").cast("string").alias("label"),
                                                          F.col("url_text").alias("text")), order)
    pair = MarkovPair.build(counts, order)
    scored = score_urls(sample.where("held"), pair, ["accepted"])
    pair.calibrate(scored.groupBy("accepted", F.round("score", 3).alias("score")).count().collect())
    return pair


def _kernel(model, n_keep: int):
    def run(batches):
        import pyarrow as pa
        m = model.value
        for b in batches:
            s = m.scores(b.column(n_keep).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], pa.array(s, pa.float64())],
                                             names=[*b.schema.names[:n_keep], "score"])
    return run


def score_urls(urls: DataFrame, pair: MarkovPair, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score``: mean log-likelihood difference a character of ``url_text`` (0 if empty)."""
    prepare(urls.sparkSession)
    model = urls.sparkSession.sparkContext.broadcast(pair)
    src = urls.select(*keep, "url_text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(_kernel(model, len(keep)), f"{kept}, score double")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
          order: int = 5, max_rows: int | None = None) -> DataFrame:
    """One row per input row: ``(page_id, host, path, rule, verdict, score)``.

    The rules' verdicts label the URLs that the models learn from.  Without a rule the verdict is ``allow``
    if the score is at least the calibrated threshold, else ``block``.  Null URLs and URLs without ``://`` have
    an empty host and path and score 0; with no labelled URL, or only one label, every score is 0 and the
    verdict ``allow``.  Repeated rows are judged alike; extra columns are not read.
    """
    host, path = host_of(F.col("_url")), path_of(F.col("_url"))
    rule, says = rule_expression(rules, F.col("host"), F.col("path"))
    seen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url")) \
        .select("page_id", host.alias("host"), path.alias("path")) \
        .select("*", rule.alias("rule"), says.alias("_says")) \
        .withColumn("url_text", normalise_url(F.col("host"), F.col("path")))
    pair = fit(seen.where("_says is not null").select("url_text", (F.col("_says") == "allow").alias("accepted")),
               order, max_rows)
    scored = score_urls(seen, pair, ["page_id", "host", "path", "rule", "_says"])
    by_model = F.when(F.col("score") >= F.lit(pair.threshold), F.lit("allow")).otherwise(F.lit("block"))
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("_says", by_model).alias("verdict"), "score")
