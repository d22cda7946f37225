"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact word budgets.

Only DataFrame functions.  Every document gets a random key from a hash of its id; the key's leading
digits cut each source into ranges of about ``rows_per_range`` documents, so a source with a third of
all rows is sorted and summed in many tasks.  A prefix sum is (sum of the earlier ranges) + (running
sum inside the range).  Only ``(id, source, size, key)`` is shuffled for it, never a text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import cut, numbered

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
KEY_DIGITS = 10  # hexadecimal digits of the key that choose the range: up to 2^22 ranges a source


def word_count(text: Column) -> Column:
    """Words of a text; null counts as none.  White space is 20 and 09-0D only."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(seed: int, *cols: Column) -> Column:
    """Hexadecimal random key, the same in any engine that has md5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                   epochs: float = 2.0) -> DataFrame:
    """``(source, rows, source_size, target)`` from ``(source, size)`` rows.

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` of all sizes;
    a target stops at ``epochs`` times its source's size and the excess goes to the others by weight.
    The fixed point is ``min(cap, level * weight)``: with sources sorted by cap / weight, the first one
    that its share doesn't fill sets the level, (budget - caps before it) / (weights from it on).
    The windows run over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.lit(float(weights[0]))
    for i, w in enumerate(weights[1:], 1):
        weight = F.when(F.col("_turn") == i, F.lit(float(w))).otherwise(weight)
    ranked = per.withColumn("_turn", turn).withColumn("_w", weight) \
        .withColumn("_cap", F.col("source_size") * F.lit(float(epochs)))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    filled = ranked.withColumn("_no", F.row_number().over(order)) \
        .withColumn("_left", F.sum("source_size").over(whole) * F.lit(float(share)) - before) \
        .withColumn("_rest", F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))) \
        .withColumn("_full", F.col("_left") * F.col("_w") >= F.col("_cap") * F.col("_rest")) \
        .withColumn("_at", F.min(F.when(~F.col("_full"), F.struct("_no", "_left", "_rest"))).over(whole))
    target = F.when(F.col("_at").isNull() | (F.col("_no") < F.col("_at._no")), F.col("_cap")) \
        .otherwise(F.col("_at._left") * F.col("_w") / F.col("_at._rest"))
    return filled.select("source", "rows", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: int = 17,
        rows_per_range: int = 4096) -> DataFrame:
    """One row per input row: ``(doc_id, source, size, source_size, target, taken)``.

    ``taken`` words: every whole epoch that fits the target takes all documents of the source; the last
    one goes along the random order and is cut at the exact budget, so the document on the edge is taken
    in part and the source's words miss its target by less than one.  Ties in the order (repeated rows)
    are broken by id and size.  Null and word-less texts have size 0 and take 0; a null source is a
    source; an empty table gives no rows; extra columns are not read.
    """
    sized = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                            word_count(F.col(text_col)).alias("size"))
                .withColumn("key", random_key(seed, F.col("doc_id"))))
    targets = source_targets(sized, weights, share, epochs).withColumnRenamed("source", "_source")
    digits = F.conv(F.substring("key", 1, KEY_DIGITS), 16, 10).cast("long")
    ranges = F.least(F.ceil(F.col("rows") / F.lit(rows_per_range)), F.lit(1 << 22)).cast("long")
    placed = sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))) \
        .withColumn("range", F.shiftright(digits * ranges, 4 * KEY_DIGITS))
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    earlier = Window.partitionBy("_s").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(F.col("source").alias("_s"), F.col("range").alias("_r")) \
        .agg(F.sum("size").alias("_sum")) \
        .select("_s", "_r", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target")) - passes * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("_before") - F.col("_local")))
    return local.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r"))) \
        .select("doc_id", "source", "size", "source_size", "target",
                (passes * F.col("size") + part).cast("long").alias("taken"))


def materialise(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: the input's columns, one row per copy, with ``mix_copy`` and ``mix_words``.

    Documents that take no word leave.  A document that takes more than its size is repeated, and a copy
    that takes fewer words than the document has is cut after them (``n_chars`` follows, where there is one).
    Rows that repeat an id, source and size share their words evenly, rounded up to the next word.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    source_col = options.get("source_col", "source")
    taken = mix(docs, **options).groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
                                         F.col("size").alias("_size")) \
        .agg(F.ceil(F.sum("taken") / F.count(F.lit(1))).cast("long").alias("_taken")).where("_taken > 0")
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    text = F.col(at[text_col])
    sized = numbered(docs).withColumn("_words", word_count(text))
    joined = sized.join(taken.hint("shuffle_hash"), F.col(at[id_col]).eqNullSafe(F.col("_id"))
                        & F.col(at[source_col]).cast("string").eqNullSafe(F.col("_source"))
                        & (F.col("_words") == F.col("_size")))
    copies = joined.withColumn("mix_copy", F.explode(F.sequence(
        F.lit(1), F.ceil(F.col("_taken") / F.col("_size")).cast("int")))) \
        .withColumn("mix_words", F.least(F.col("_size"), F.col("_taken") - (F.col("mix_copy") - 1) * F.col("_size")))
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"[{SPACE}]*{WORD}"), F.lit(0)),
                                F.lit(1), F.col("mix_words").cast("int")), "")
    cut_short = F.col("mix_words") < F.col("_size")
    out = copies.withColumn("_text", F.when(cut_short, head).otherwise(text))
    named = {c: F.col(k).alias(c) for c, k in at.items() if c not in ("mix_copy", "mix_words")}
    named[text_col] = F.col("_text").alias(text_col)
    if "n_chars" in named:
        kind = docs.schema["n_chars"].dataType
        named["n_chars"] = F.when(cut_short, F.char_length("_text").cast(kind)).otherwise(F.col(at["n_chars"])).alias("n_chars")
    return out.select(*named.values(), "mix_copy", "mix_words")
