"""Profiling aggregations over ``samples`` / ``windows``.

All are single hash aggregations with map-side partial aggregation; the
grouping keys (format, source prefix, type, file) have low cardinality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.schema import DEFAULT_BATCH_SIZE, DEFAULT_EPOCHS


def load_stats(samples: DataFrame) -> DataFrame:
    """Samples per format."""
    return samples.groupBy(F.coalesce("format", F.lit("unknown")).alias("format")) \
        .agg(F.count("*").alias("n_samples"))


def stats_by_source(samples: DataFrame) -> DataFrame:
    """Samples per ``source`` up to its first ':' (missing -> unknown)."""
    key = F.substring_index(F.coalesce("source", F.lit("unknown")), ":", 1)
    return samples.groupBy(key.alias("source")).agg(F.count("*").alias("n_samples"))


def stats_by_type(samples: DataFrame) -> DataFrame:
    """D3: samples per ``type`` (missing -> unknown)."""
    return samples.groupBy(F.coalesce("type", F.lit("unknown")).alias("type")).agg(F.count("*").alias("n_samples"))


def preview_text(limit: int = 100):
    first = F.when(F.col("kind") == "dialog", F.try_element_at("dialog", F.lit(1))["content"]).otherwise(F.col("text"))
    return first


def sample_preview(samples: DataFrame, limit: int = 100) -> DataFrame:
    """Total and the first sample (by file, ordinal) cut to ``limit`` chars + '...'."""
    first = F.min_by(preview_text(), F.struct("file_path", "ordinal"))
    out = samples.agg(F.count("*").alias("total"), first.alias("_p"))
    p = F.col("_p")
    return out.select("total", F.when(F.char_length(p) > limit, F.concat(F.left(p, F.lit(limit)), F.lit("...")))
                      .otherwise(p).alias("preview"))


def profile(samples: DataFrame, limit: int = 100) -> DataFrame:
    """D1–D5 in one scan: ``(by, key, n_samples, n_dialogs, n_texts, kinds, preview)``.

    ``by``: ``format``, ``source``, ``type`` or ``total`` (one row, with the preview of the first sample by file and
    ordinal).  Grouping sets over the three keys: rows are expanded inside the scan's stage, without their texts, and
    pre-aggregated before the shuffle (the set of kinds makes that a hash aggregate, which a least string alone is not).
    """
    first = F.struct(F.coalesce("file_path", F.lit("")).alias("f"), F.coalesce("ordinal", F.lit(-1)).alias("o"))
    text = preview_text()
    short = F.when(F.char_length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("..."))).otherwise(text)
    keyed = samples.select(
        F.coalesce("format", F.lit("unknown")).alias("format"),
        F.substring_index(F.coalesce("source", F.lit("unknown")), ":", 1).alias("source"),
        F.coalesce("type", F.lit("unknown")).alias("type"), (F.col("kind") == "dialog").alias("_d"), (F.col("kind") == "text").alias("_t"), "kind",
        F.struct(first.alias("at"), short.alias("preview")).alias("_p"))
    keys = [F.col(c) for c in ("format", "source", "type")]
    out = keyed.groupingSets([[k] for k in keys] + [[]], *keys).agg(
        F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n_samples"), F.count_if("_d").alias("n_dialogs"), F.count_if("_t").alias("n_texts"),
        F.sort_array(F.collect_set("kind")).alias("kinds"), F.min("_p").alias("_p"))
    by = F.when(F.col("_g") == 3, "format").when(F.col("_g") == 5, "source").when(F.col("_g") == 6, "type").otherwise("total")
    return out.select(by.alias("by"), F.coalesce("format", "source", "type").alias("key"), "n_samples", "n_dialogs", "n_texts", "kinds",
                      F.when(F.col("_g") == 7, F.col("_p")["preview"]).alias("preview"))


def corpus_composition(samples: DataFrame) -> DataFrame:
    """Dialogs vs texts (callers raise on an empty corpus)."""
    return samples.agg(F.count_if(F.col("kind") == "dialog").alias("n_dialogs"),
                       F.count_if(F.col("kind") == "text").alias("n_texts"))


def require_content(samples: DataFrame) -> tuple[int, int]:
    """D5's error: raise when there is neither a dialog nor a text; returns (dialogs, texts)."""
    r = corpus_composition(samples).first()
    if r is None or (r.n_dialogs or 0) + (r.n_texts or 0) == 0:
        raise ValueError("no valid text content found in data")
    return r.n_dialogs, r.n_texts


def training_plan(windows: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE, epochs: int = DEFAULT_EPOCHS,
                  resumed: int = 0) -> DataFrame:
    """Windows, batches = ceil(n / batch), steps = batches * (epochs - resumed)."""
    n = F.count("*")
    batches = F.ceil(n / F.lit(batch_size)).cast("long")
    return windows.agg(n.alias("n_windows"), batches.alias("batches"),
                       (batches * F.lit(epochs - resumed)).alias("steps"))


def plan_of_lengths(lengths: DataFrame, seq_len: int, stride: int, batch_size: int = DEFAULT_BATCH_SIZE,
                    epochs: int = DEFAULT_EPOCHS, resumed: int = 0) -> DataFrame:
    """D6 from ``(sample_id, n_tokens)``: the number of windows is arithmetic, nothing is tokenized."""
    from chatloom.operators.windows import window_count
    n = F.coalesce(F.sum(window_count(F.col("n_tokens"), seq_len, stride)), F.lit(0))
    batches = F.ceil(n / F.lit(batch_size)).cast("long")
    return lengths.agg(n.cast("long").alias("n_windows"), batches.alias("batches"),
                       (batches * F.lit(epochs - resumed)).alias("steps"))


def turn_totals(samples: DataFrame) -> DataFrame:
    """Per file, samples and assistant turns (formats without turns count items)."""
    return samples.groupBy("file_path").agg(
        F.count("*").alias("n_samples"),
        F.sum(F.coalesce(F.col("turns").cast("long"), F.lit(1).cast("long"))).alias("turn_total"))
