"""E1 corpus parts, E2 vocabulary, A13 vocabulary persistence."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions.kernels import CharLookup, distinct_code_points
from chatloom.functions.text import role_marker
from chatloom.plans.runtime import ensure_package
from chatloom.schema import ROLE_MARKERS, SPECIAL_TOKENS, VOCAB

# A vocabulary is a set of distinct code points: it can never exceed this.
MAX_VOCAB_ROWS = 0x110000 + len(SPECIAL_TOKENS)


def corpus_parts(samples: DataFrame) -> DataFrame:
    """(sample_id, part_no, part) — the pieces the vocabulary corpus is joined from.

    Dialog: per turn its role marker (if any) then its content; then ``<eos>``.
    Text: the text then ``<eos>``.  The joined corpus string is never built.
    """
    turn_parts = F.flatten(F.transform(
        F.col("dialog"),
        lambda t: F.when(role_marker(t["role"]).isNull(), F.array(t["content"]))
        .otherwise(F.array(role_marker(t["role"]), t["content"])),
    ))
    parts = F.when(F.col("kind") == "dialog", F.concat(turn_parts, F.array(F.lit("<eos>")))) \
        .otherwise(F.array(F.col("text"), F.lit("<eos>")))
    return samples.select("sample_id", F.posexplode(parts).alias("part_no", "part")).where(F.col("part").isNotNull())


def distinct_chars(df: DataFrame, col: str) -> DataFrame:
    """Distinct code points of a string column, one row per (task batch, character).

    A numpy kernel dedups inside each Arrow batch (memory bounded by a slice of
    text, however long a single text is); Spark's hash ``distinct`` does the rest.
    """
    spark = df.sparkSession
    ensure_package(spark)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            cps = distinct_code_points(b.column(0).to_pylist())
            toks = [chr(c) for c in cps.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(toks, pa.string())], names=["token"])

    return df.select(F.col(col)).mapInArrow(run, "token string").distinct()


def number_tokens(distinct: DataFrame) -> DataFrame:
    """Specials 0..6, then the distinct characters in code-point order (≤ ~1.1 M rows to number)."""
    spark = distinct.sparkSession
    numbered = distinct.select(
        "token",
        (F.row_number().over(Window.orderBy("token")) + len(SPECIAL_TOKENS) - 1).cast("int").alias("id"),
        F.lit(False).alias("is_special"),
    )
    specials = spark.createDataFrame([(t, i, True) for i, t in enumerate(SPECIAL_TOKENS)], VOCAB)
    return specials.unionByName(numbered)


class _SureChars:
    """What one task knows of the vocabulary: characters of dialogs that are certainly kept.

    A dialog with an assistant turn in the batch is kept, so its characters count at once, whatever dialog they came
    from.  Characters of the others are only worth a (dialog, character) pair if they aren't sure already.  The set
    has at most one entry per code point.
    """

    def __init__(self):
        self.seen = np.empty(0, dtype=np.uint32)

    def rows(self, ids, roles, texts):
        """``(dialog or None, character)`` of a batch: newly sure ones, then pairs of undecided dialogs."""
        strs, kept = {}, set()
        for i, r, t in zip(ids, roles, texts):
            strs.setdefault(i, []).extend([t, ROLE_MARKERS.get(r)])
            if r == "assistant":
                kept.add(i)
        sure = np.setdiff1d(distinct_code_points(s for i in kept if i is not None for s in strs[i]), self.seen)
        self.seen = np.union1d(self.seen, sure)
        out_i, out_t = [None] * len(sure), [chr(c) for c in sure.tolist()]
        for i, own in strs.items():
            if i is not None and i not in kept:
                new = np.setdiff1d(distinct_code_points(own), self.seen)
                out_i += [i] * len(new)
                out_t += [chr(c) for c in new.tolist()]
        return out_i, out_t


def kept_chars(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Characters of ``rows(_id, token)``: the sure ones (no id) and those of kept dialogs."""
    known = kept.select("_id", F.lit(True).alias("_kept"))
    chars = rows.distinct().join(known, "_id", "left").where("_id is null or _kept").select("token")
    tail = kept.limit(1).select(F.explode(F.array(*[F.lit(c) for c in "<eos>\n"])).alias("token"))
    return chars.unionByName(tail).distinct()


def dialog_chars(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """Distinct corpus characters of the kept dialogs of a turn table ``(_id, _role, _text)``.

    A task sends each character of dialogs that it sees to be kept once, and (dialog, character) pairs only for
    characters that it hasn't sent and dialogs whose assistant turn it hasn't seen: neither text nor a dialog's
    characters are shuffled, however the turns lie in the table.
    """
    spark = turns.sparkSession
    ensure_package(spark)

    def run(batches):
        import pyarrow as pa
        sure = _SureChars()
        for b in batches:
            i, t = sure.rows(*(b.column(k).to_pylist() for k in range(3)))
            yield pa.RecordBatch.from_arrays([pa.array(i, b.column(0).type), pa.array(t, pa.string())], names=["_id", "token"])

    kind = turns.schema["_id"].dataType.simpleString()
    return kept_chars(turns.select("_id", "_role", "_text").mapInArrow(run, f"_id {kind}, token string"), kept)


def turn_table_vocab(turns: DataFrame, id_col: str = "conv_id", role_col: str = "role",
                     text_col: str = "text") -> DataFrame:
    """E2 over a turn-per-row table without assembling dialogs (kept = has an assistant turn)."""
    from chatloom.sources.tables import dialog_key
    t = turns.select(dialog_key(turns, id_col).alias("_id"), F.col(role_col).alias("_role"),
                     F.col(text_col).alias("_text"))
    kept = t.groupBy("_id").agg(F.count_if(F.col("_role") == "assistant").alias("_na")).where("_na > 0")
    return number_tokens(dialog_chars(t, kept))


def dialog_profile(turns: DataFrame) -> DataFrame:
    """One scan of a turn table ``(_id, _ord, _role, _text)`` → rows of two kinds:

    * ``(_id, token)`` — characters as in ``dialog_chars``: without an id those that are surely in the vocabulary,
      with one those that depend on the dialog;
    * ``(_id, token=NULL, _n, _na, _last, _chars)`` — partial dialog stats (turns, assistant
      turns, last turn key, characters).

    Callers aggregate the stats by dialog and dedup the characters; the text is read once for both.
    """
    spark = turns.sparkSession
    ensure_package(spark)

    def run(batches):
        import pyarrow as pa
        sure = _SureChars()
        for b in batches:
            ids, ords, roles, texts = (b.column(k).to_pylist() for k in range(4))
            out_i, out_t = sure.rows(ids, roles, texts)
            st: dict = {}
            for i, o, r, t in zip(ids, ords, roles, texts):
                n, na, last, chars = st.get(i, (0, 0, None, 0))
                st[i] = (n + 1, na + (r == "assistant"), o if last is None or (o is not None and o > last) else last,
                         chars + (len(t) if t else 0))
            blank = [None] * len(out_i)
            stats = [blank + list(c) for c in zip(*st.values())] if st else [blank] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_i + list(st), b.column(0).type), pa.array(out_t + [None] * len(st), pa.string()),
                 *(pa.array(c, pa.int64()) for c in stats)],
                names=["_id", "token", "_n", "_na", "_last", "_chars"])

    kind = turns.schema["_id"].dataType.simpleString()
    return turns.select("_id", "_ord", "_role", "_text").mapInArrow(
        run, f"_id {kind}, token string, _n long, _na long, _last long, _chars long")


def build_vocab(parts: DataFrame) -> DataFrame:
    """Ids 0..6 are the specials, then the corpus' distinct code points in code-point order.

    Per-batch dedup in a numpy kernel, then a hash ``distinct``: the shuffle is
    bounded by the number of distinct characters per task.  The final numbering
    runs over at most ~1.1 M distinct code points.
    """
    spark = parts.sparkSession
    chars = distinct_chars(parts, "part")
    # the parts are joined by "\n": it is in the corpus whenever the corpus is non-empty
    newline = parts.limit(1).select(F.lit("\n").alias("token"))
    return number_tokens(chars.unionByName(newline).distinct())


def vocab_from_samples(samples: DataFrame) -> DataFrame:
    return build_vocab(corpus_parts(samples))


def collect_lookup(vocab: DataFrame) -> CharLookup:
    """Bring the (bounded) vocabulary to the driver as a lookup for broadcast."""
    rows = vocab.select("token", "id", "is_special").limit(MAX_VOCAB_ROWS + 1).collect()
    if len(rows) > MAX_VOCAB_ROWS:
        raise ValueError("vocabulary larger than the number of Unicode code points: not a char vocabulary")
    return CharLookup.from_vocab_rows([(r[0], r[1], r[2]) for r in rows])


def save_vocab(vocab: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persist the whole vocabulary, specials included."""
    vocab.select("token", "id", "is_special").coalesce(1).write.mode(mode).parquet(path)


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOCAB).parquet(path)
