"""Encode texts and dialogs, decode ids, unknown characters, prompt rendering."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.kernels import HELD, CharLookup, iter_samples, row_slices, sample_slices
from chatloom.functions.text import col_, py_strip
from chatloom.operators.vocab import collect_lookup
from chatloom.plans.runtime import broadcast_value, ensure_package
from chatloom.schema import TOKENS, UNK_ID


def _lookup(vocab) -> CharLookup:
    return vocab if isinstance(vocab, CharLookup) else collect_lookup(vocab)


def encode_samples(samples: DataFrame, vocab, escape_specials: bool = False) -> DataFrame:
    """E3/E4 (+F1): (sample_id, kind, token_ids).

    Texts: scan of special strings / code points, then ``<eos>``.  Dialogs: per turn
    the role token (user 4, assistant 5, others none) and the content, one ``<eos>``
    at the end.  Narrow stage: the vocabulary is broadcast, no shuffle.
    """
    spark = samples.sparkSession
    ensure_package(spark)
    bc = broadcast_value(spark, _lookup(vocab))
    cols = [c for c in ("sample_id", "kind", "text", "dialog") if c in samples.columns]

    def run(batches):
        lookup = bc.value
        for b in (part for whole in batches for part in sample_slices(whole)):
            sids, kinds, offs, vals = [], [], [0], []
            for sid, kind, toks in iter_samples(b, lookup, escape_specials):
                sids.append(sid)
                kinds.append(kind)
                vals.append(toks)
                offs.append(offs[-1] + len(toks))
            flat = np.concatenate(vals) if vals else np.empty(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sids, pa.string()), pa.array(kinds, pa.string()), ids], names=TOKENS.names)

    return samples.select(*cols).mapInArrow(run, TOKENS)


def encode_text_column(df: DataFrame, text_col: str, vocab, escape_specials: bool = False,
                       append_eos: bool = False, id_col: str = "sample_id") -> DataFrame:
    """E3 on any table: (id, token_ids) for one string column."""
    src = df.select(F.col(id_col).cast("string").alias("sample_id"), F.lit("text").alias("kind"),
                    F.col(text_col).alias("text"))
    out = encode_samples(src, vocab, escape_specials)
    if not append_eos:
        out = out.withColumn("token_ids", F.slice("token_ids", 1, F.size("token_ids") - 1))
    return out.select(F.col("sample_id").alias(id_col), "token_ids")


def decode_column(df: DataFrame, ids_col: str, vocab, out_col: str = "decoded") -> DataFrame:
    """E5: id -> token string (unknown id -> ``<unk>``), concatenated.  Arrow kernel, broadcast table."""
    spark = df.sparkSession
    ensure_package(spark)
    if isinstance(vocab, DataFrame):
        from chatloom.operators.vocab import MAX_VOCAB_ROWS
        rows = vocab.select("id", "token").limit(MAX_VOCAB_ROWS + 1).collect()
        if len(rows) > MAX_VOCAB_ROWS:
            raise ValueError("vocabulary larger than the number of Unicode code points: not a char vocabulary")
    else:
        rows = vocab
    size = max((r[0] for r in rows), default=-1) + 1
    itos = np.array(["<unk>"] * max(size, 1), dtype=object)
    for i, t in rows:
        itos[i] = t
    bc = broadcast_value(spark, itos)
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out_col, T.StringType())])

    def run(batches):
        table = bc.value
        n = len(table)
        for b in (part for whole in batches for part in row_slices(whole, whole.schema.get_field_index(ids_col))):
            col = b.column(b.schema.get_field_index(ids_col))
            offs = col.offsets.to_numpy()
            vals = col.values.to_numpy(zero_copy_only=False)
            valid = col.is_valid().to_numpy(zero_copy_only=False)
            out = []
            for i in range(len(col)):
                if not valid[i]:
                    out.append(None)
                    continue
                pieces = []
                for lo in range(offs[i], offs[i + 1], HELD):
                    ids = vals[lo:min(lo + HELD, offs[i + 1])]
                    ok = (ids >= 0) & (ids < n)
                    toks = np.where(ok, table[np.where(ok, ids, 0)], "<unk>")
                    pieces.append("".join(toks.tolist()))
                out.append("".join(pieces))
            yield pa.RecordBatch.from_arrays(list(b.columns) + [pa.array(out, pa.string())],
                                             names=list(b.schema.names) + [out_col])

    return df.mapInArrow(run, schema)


def encode_turns(turns: DataFrame, vocab, id_col: str = "conv_id", order_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", source_name: str = "conversations",
                 escape_specials: bool = False) -> DataFrame:
    """E4 over a turn-per-row table without assembling dialogs.

    One row per turn with tokens, of each kept dialog (one with an assistant turn), plus one
    ``<eos>`` row per dialog (``turn`` NULL): ``(sample_id, turn, pos0, n_tokens,
    token_ids)``, where ``pos0`` is the position of the row's first token in the
    dialog's sequence — the same ids ``encode_samples`` gives an assembled dialog,
    cut at turn borders.  Positions are exclusive prefix sums of token counts over range
    partitions, so a dialog holding most rows is spread over many tasks.
    """
    from chatloom.operators.windows import placed_turns
    from chatloom.sources.tables import dialog_key
    spark = turns.sparkSession
    ensure_package(spark)
    bc = broadcast_value(spark, _lookup(vocab))
    t = turns.select(dialog_key(turns, id_col).alias("_id"), F.col(order_col).cast("long").alias("_ord"),
                     F.col(role_col).alias("_role"), F.col(text_col).alias("_text"))
    # B6 per dialog by a partial aggregate (map-side combine, one small row per dialog)
    dlg = t.groupBy("_id").agg(F.count_if(F.col("_role") == "assistant").alias("_na"),
                               F.max("_ord").alias("_last")).where("_na > 0 and _id is not null")
    pre = placed_turns(t.join(dlg.select("_id"), "_id", "left_semi"), dlg, bc, escape_specials)
    return pre.select(F.concat(F.lit(source_name + ":"), F.col("_id").cast("string")).alias("sample_id"),
                      F.col("_ord").alias(order_col), F.col("g0").alias("pos0"), F.col("n").alias("n_tokens"),
                      F.col("ids").alias("token_ids"))


def unknown_stats(tokens: DataFrame, ids_col: str = "token_ids") -> DataFrame:
    """OOV count and rate per sample (ids equal to ``<unk>``)."""
    n = F.size(ids_col)
    unk = F.size(F.filter(ids_col, lambda x: x == UNK_ID))
    return tokens.select("sample_id", n.cast("long").alias("n_tokens"), unk.cast("long").alias("n_unknown"),
                         F.try_divide(unk, n).alias("unk_rate"))


def render_prompt(prompt) -> Column:
    """``<user>{prompt}<assistant>`` (once)."""
    return F.concat(F.lit("<user>"), col_(prompt), F.lit("<assistant>"))


def extract_response(decoded) -> Column:
    """Text after the last ``<assistant>``, ``<eos>`` removed, Python-stripped; unchanged without marker."""
    c = col_(decoded)
    tail = F.replace(F.substring_index(c, "<assistant>", -1), F.lit("<eos>"), F.lit(""))
    return F.when(F.instr(c, "<assistant>") > 0, py_strip(tail)).otherwise(c)
