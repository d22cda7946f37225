"""The query catalog: one Spark plan per operator of the inventory, each with its
DuckDB oracle where SQL can express it.

Every query reads the given tables (or data Spark derives from them) in full.
Array results are rendered as comma-joined strings so both engines hash the
same values; floating values are rounded to 6 places in both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators import tokenize as tok
from chatloom.operators import windows as win
from chatloom.operators.normalize import answered_dialogs
from chatloom.operators.vocab import corpus_parts, turn_table_vocab, vocab_from_samples
from chatloom.plans import oracle as O
from chatloom.sources.tables import assemble_dialogs, read_table, spread_scan, text_samples

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def ids_str(c) -> Column:
    return F.array_join(F.col(c).cast("array<string>") if isinstance(c, str) else c.cast("array<string>"), ",")


def mask_str(c) -> Column:
    return F.array_join(F.col(c).cast("array<string>"), "")


def arr_sum(c) -> Column:
    return F.aggregate(F.col(c) if isinstance(c, str) else c, F.lit(0).cast("long"), lambda a, x: a + x)


# -- shared inputs ---------------------------------------------------------------------------------
def all_dialogs(spark, d):
    return assemble_dialogs(read_table(spark, d, "conversations"))


def kept_dialogs(spark, d):
    from chatloom.operators.normalize import keep_answered_dialogs
    return keep_answered_dialogs(all_dialogs(spark, d))


def dialog_lengths(spark, d):
    """(sample_id, n_tokens) of the kept dialogs: role token + content tokens per turn, one <eos>; no tokenization."""
    from chatloom.functions.text import token_count
    per_turn = F.when(F.col("role").isin("user", "assistant"), 1).otherwise(0) + token_count("text")
    g = read_table(spark, d, "conversations").groupBy("conv_id").agg(
        F.count_if(F.col("role") == "assistant").alias("na"), (F.sum(per_turn) + 1).alias("n_tokens"))
    return g.where("na > 0").select(F.concat(F.lit("conversations:"), F.col("conv_id").cast("string")).alias("sample_id"), "n_tokens")


def doc_lengths(spark, d):
    """(sample_id, n_tokens) of document texts, <eos> included; no tokenization."""
    from chatloom.functions.text import token_count
    return read_table(spark, d, "documents").where("text is not null").select(
        F.concat(F.lit("documents:"), F.col("doc_id").cast("string")).alias("sample_id"), (token_count("text") + 1).alias("n_tokens"))


def doc_samples(spark, d):
    return text_samples(spread_scan(read_table(spark, d, "documents")))


# -- B7 / B6 ----------------------------------------------------------------------------------------
@register("assemble_dialogs", O.with_(O.dialog_turns(kept=False)) + """
SELECT sample_id, count(*)::BIGINT AS n_msgs, (count(*) FILTER (WHERE role = 'assistant'))::BIGINT AS turns,
       md5(string_agg(role || ':' || content, chr(10) ORDER BY turn)) AS dialog_md5
FROM dlg_turns GROUP BY sample_id""")
def q_assemble_dialogs(spark, d):
    s = all_dialogs(spark, d)
    text = F.array_join(F.transform("dialog", lambda t: F.concat(t["role"], F.lit(":"), t["content"])), "\n")
    return s.select("sample_id", F.size("dialog").cast("long").alias("n_msgs"), F.col("turns").cast("long"),
                    F.md5(text).alias("dialog_md5"))


@register("keep_answered_dialogs", O.with_(O.dialog_turns(kept=True)) + """
SELECT sample_id, count(*)::BIGINT AS n_msgs, (count(*) FILTER (WHERE role = 'assistant'))::BIGINT AS turns
FROM dlg_turns GROUP BY sample_id""")
def q_keep_answered(spark, d):
    return answered_dialogs(read_table(spark, d, "conversations")).select(
        F.concat(F.lit("conversations:"), F.col("conv_id").cast("string")).alias("sample_id"), "n_msgs", "turns")


# -- E1 / E2 ------------------------------------------------------------------------------------------
@register("corpus_parts", O.with_(O.dialog_turns()) + """,
p AS (
  SELECT sample_id, turn AS ord, 0 AS sub, CASE role WHEN 'user' THEN '<user>' WHEN 'assistant' THEN '<assistant>'
         WHEN 'system' THEN '<system>' END AS part FROM dlg_turns
  UNION ALL SELECT sample_id, turn, 1, content FROM dlg_turns
  UNION ALL SELECT DISTINCT sample_id, 9223372036854775807, 0, '<eos>' FROM dlg_turns
)
SELECT sample_id, (row_number() OVER (PARTITION BY sample_id ORDER BY ord, sub) - 1)::BIGINT AS part_no, part
FROM p WHERE part IS NOT NULL""")
def q_corpus_parts(spark, d):
    return corpus_parts(kept_dialogs(spark, d)).select("sample_id", F.col("part_no").cast("long"), "part")


@register("build_vocab", O.with_(O.dialog_turns(), O.dialog_vocab()) + "SELECT token, id, is_special FROM vocab")
def q_build_vocab(spark, d):
    return turn_table_vocab(read_table(spark, d, "conversations"))


# -- E3–E8 -----------------------------------------------------------------------------------------------
@register("encode_dialog", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids()) + """
SELECT sample_id, count(*)::BIGINT AS n_tokens, string_agg(id::VARCHAR, ',' ORDER BY pos) AS token_ids
FROM ids GROUP BY sample_id""")
def q_encode_dialog(spark, d):
    t = _dialog_tokens(spark, d)
    return t.select("sample_id", F.size("token_ids").cast("long").alias("n_tokens"), ids_str("token_ids").alias("token_ids"))


_EOS_ORD = "CASE WHEN ord = 9223372036854775807 THEN NULL ELSE ord END::BIGINT AS turn"


@register("encode_turns", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids(with_ord=True)) + f"""
SELECT sample_id, {_EOS_ORD}, min(pos)::BIGINT AS pos0, count(*)::BIGINT AS n_tokens,
       string_agg(id::VARCHAR, ',' ORDER BY pos) AS token_ids
FROM ids GROUP BY sample_id, ord""")
def q_encode_turns(spark, d):
    c = read_table(spark, d, "conversations")
    t = tok.encode_turns(c, turn_table_vocab(c))
    return t.select("sample_id", "turn", "pos0", "n_tokens", ids_str("token_ids").alias("token_ids"))


@register("decode_turns", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids(with_ord=True)) + f"""
SELECT i.sample_id, {_EOS_ORD.replace("ord", "i.ord")}, md5(string_agg(v.token, '' ORDER BY i.pos)) AS decoded_md5,
       sum(length(v.token))::BIGINT AS n_chars
FROM ids i JOIN vocab v ON v.id = i.id GROUP BY i.sample_id, i.ord""")
def q_decode_turns(spark, d):
    c = read_table(spark, d, "conversations")
    v = turn_table_vocab(c).cache()
    t = tok.decode_column(tok.encode_turns(c, v), "token_ids", v, out_col="decoded")
    return t.select("sample_id", "turn", F.md5("decoded").alias("decoded_md5"),
                    F.char_length("decoded").cast("long").alias("n_chars"))


@register("encode_text", O.with_(O.doc_texts(), O.text_vocab(), O.text_ids(eos=False)) + """
SELECT sample_id, count(*)::BIGINT AS n_tokens, md5(string_agg(id::VARCHAR, ',' ORDER BY pos)) AS ids_md5,
       sum(id)::BIGINT AS ids_sum
FROM tids GROUP BY sample_id""")
def q_encode_text(spark, d):
    s = doc_samples(spark, d)
    t = tok.encode_text_column(s, "text", vocab_from_samples(s), append_eos=False)
    return t.select("sample_id", F.size("token_ids").cast("long").alias("n_tokens"),
                    F.md5(ids_str("token_ids")).alias("ids_md5"), arr_sum("token_ids").alias("ids_sum"))


@register("decode_tokens", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids()) + """
SELECT i.sample_id, md5(string_agg(v.token, '' ORDER BY i.pos)) AS decoded_md5,
       sum(length(v.token))::BIGINT AS n_chars
FROM ids i JOIN vocab v ON v.id = i.id GROUP BY i.sample_id""")
def q_decode_tokens(spark, d):
    v = turn_table_vocab(read_table(spark, d, "conversations")).cache()  # at most one row a code point
    t = tok.decode_column(tok.encode_samples(kept_dialogs(spark, d), v), "token_ids", v, out_col="decoded")
    return t.select("sample_id", F.md5("decoded").alias("decoded_md5"), F.char_length("decoded").cast("long").alias("n_chars"))


@register("unknown_chars", O.with_(O.dialog_turns(), O.dialog_vocab(), O.doc_texts(),
                                   O.text_ids(vocab="vocab", eos=False)) + """
SELECT sample_id, count(*)::BIGINT AS n_tokens, (count(*) FILTER (WHERE id = 1))::BIGINT AS n_unknown,
       round((count(*) FILTER (WHERE id = 1)) / count(*), 6) AS unk_rate
FROM tids GROUP BY sample_id""")
def q_unknown_chars(spark, d):
    v = turn_table_vocab(read_table(spark, d, "conversations"))
    t = tok.encode_text_column(doc_samples(spark, d), "text", v, append_eos=False)
    u = tok.unknown_stats(t)
    return u.select("sample_id", "n_tokens", "n_unknown", F.round("unk_rate", 6).alias("unk_rate"))


@register("render_prompt", """
SELECT 'conversations:' || conv_id AS sample_id, turn, '<user>' || text || '<assistant>' AS prompt
FROM conversations WHERE role = 'user'""")
def q_render_prompt(spark, d):
    c = read_table(spark, d, "conversations").where("role = 'user'")
    return c.select(F.concat(F.lit("conversations:"), F.col("conv_id").cast("string")).alias("sample_id"), "turn",
                    tok.render_prompt("text").alias("prompt"))


def _generated(role, text) -> Column:
    """A generated-looking output string for each turn: assistant turns are wrapped like a model reply."""
    return F.when(role == "assistant",
                  F.concat(F.lit("<user>q<assistant>\n "), text, F.lit(" \u3000<eos>"))).otherwise(text)


@register("extract_response", f"""
WITH g AS (
  SELECT 'conversations:' || conv_id AS sample_id, turn,
         CASE WHEN role = 'assistant' THEN '<user>q<assistant>' || chr(10) || ' ' || text || ' ' || chr(12288) || '<eos>'
              ELSE text END AS s
  FROM conversations
)
SELECT sample_id, turn,
       CASE WHEN strpos(s, '<assistant>') > 0
            THEN trim(replace(string_split(s, '<assistant>')[-1], '<eos>', ''), {O.PY_WS_SQL}) ELSE s END AS response
FROM g""")
def q_extract_response(spark, d):
    c = read_table(spark, d, "conversations")
    return c.select(F.concat(F.lit("conversations:"), F.col("conv_id").cast("string")).alias("sample_id"), "turn",
                    tok.extract_response(_generated(F.col("role"), F.col("text"))).alias("response"))


# -- F1–F7 ----------------------------------------------------------------------------------------------
def _doc_tokens(spark, d):
    s = doc_samples(spark, d)
    return tok.encode_samples(s, vocab_from_samples(s))


def _dialog_tokens(spark, d):
    # the vocabulary comes from the turns, so dialogs are put together once and never held
    return tok.encode_samples(kept_dialogs(spark, d), turn_table_vocab(read_table(spark, d, "conversations")))


@register("append_eos", O.with_(O.doc_texts(), O.text_vocab(), O.text_ids()) + """
SELECT sample_id, count(*)::BIGINT AS n_tokens, arg_max(id, pos) AS last_id FROM tids GROUP BY sample_id""")
def q_append_eos(spark, d):
    t = _doc_tokens(spark, d)
    return t.select("sample_id", F.size("token_ids").cast("long").alias("n_tokens"),
                    F.element_at("token_ids", -1).alias("last_id"))


@register("pad_windows", O.with_(O.doc_texts(), O.text_vocab(), O.text_ids(), O.windows("tids")) + f"""
SELECT sample_id, any_value(L)::BIGINT AS n_tokens, ({O.S + 1} - any_value(L))::BIGINT AS n_pad,
       string_agg(id::VARCHAR, ',' ORDER BY off) AS window
FROM win WHERE L <= {O.S + 1} GROUP BY sample_id""")
def q_pad_windows(spark, d):
    t = _doc_tokens(spark, d).where(F.size("token_ids") <= O.S + 1)
    n = F.size("token_ids").cast("long")
    w = win.cut_windows(t.select("sample_id", n.alias("n_tokens"), "token_ids"), O.S, O.STRIDE, keep=["n_tokens"])
    return w.select("sample_id", "n_tokens", (O.S + 1 - F.col("n_tokens")).alias("n_pad"), ids_str("window").alias("window"))


@register("sliding_windows", O.with_(O.doc_texts(), O.text_vocab(), O.text_ids()) + f""",
lens AS (SELECT sample_id, count(*) AS L FROM tids GROUP BY sample_id)
SELECT sample_id, L::BIGINT AS n_tokens, (s // {O.STRIDE})::INTEGER AS window_no, s::BIGINT AS start
FROM (SELECT sample_id, L, unnest(CASE WHEN L <= {O.S + 1} THEN [0] ELSE range(0, L - {O.S}, {O.STRIDE}) END) AS s
      FROM lens)""")
def q_sliding_windows(spark, d):
    return win.window_numbers(doc_lengths(spark, d), O.S, O.STRIDE).select(
        "sample_id", "n_tokens", "window_no", "start")


@register("next_token_pairs", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids(), O.windows()) + f"""
SELECT sample_id, window_no,
       string_agg(id::VARCHAR, ',' ORDER BY off) FILTER (WHERE off < {O.S}) AS input_ids,
       string_agg(id::VARCHAR, ',' ORDER BY off) FILTER (WHERE off > 0) AS target_ids
FROM win GROUP BY sample_id, window_no""")
def q_next_token_pairs(spark, d):
    p = win.next_token_pairs(win.cut_windows(_dialog_tokens(spark, d), O.S, O.STRIDE))
    return p.select("sample_id", "window_no", ids_str("input_ids").alias("input_ids"),
                    ids_str("target_ids").alias("target_ids"))


@register("loss_mask", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids(), O.windows()) + f"""
SELECT sample_id, window_no, string_agg(mask::VARCHAR, '' ORDER BY off) FILTER (WHERE off < {O.S}) AS loss_mask
FROM win GROUP BY sample_id, window_no""")
def q_loss_mask(spark, d):
    w, _ = dialog_windows(spark, d)
    return w.select("sample_id", "window_no", mask_str("loss_mask").alias("loss_mask"))


@register("mask_coverage", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids(), O.windows()) + f"""
SELECT sample_id, count(DISTINCT window_no)::BIGINT AS n_windows, sum(mask)::BIGINT AS mask_sum,
       round(sum(mask) / (count(DISTINCT window_no) * {O.S}), 6) AS coverage
FROM win GROUP BY sample_id""")
def q_mask_coverage(spark, d):
    c = win.mask_coverage(dialog_windows(spark, d)[0])
    return c.select("sample_id", "n_windows", "mask_sum", F.round("coverage", 6).alias("coverage"))


@register("build_windows", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids(), O.windows()) + f"""
SELECT sample_id, window_no,
       string_agg(id::VARCHAR, ',' ORDER BY off) FILTER (WHERE off < {O.S}) AS input_ids,
       string_agg(id::VARCHAR, ',' ORDER BY off) FILTER (WHERE off > 0) AS target_ids,
       string_agg(mask::VARCHAR, '' ORDER BY off) FILTER (WHERE off < {O.S}) AS loss_mask
FROM win GROUP BY sample_id, window_no""")
def q_build_windows(spark, d):
    w, _ = dialog_windows(spark, d)
    return w.select("sample_id", "window_no", ids_str("input_ids").alias("input_ids"),
                    ids_str("target_ids").alias("target_ids"), mask_str("loss_mask").alias("loss_mask"))


@register("build_windows_text", O.with_(O.doc_texts(), O.text_vocab(), O.text_ids(), O.windows("tids")) + f"""
SELECT sample_id, window_no,
       md5(string_agg(id::VARCHAR, ',' ORDER BY off) FILTER (WHERE off < {O.S})) AS input_md5,
       md5(string_agg(id::VARCHAR, ',' ORDER BY off) FILTER (WHERE off > 0)) AS target_md5,
       sum(mask)::BIGINT AS mask_sum
FROM win GROUP BY sample_id, window_no""")
def q_build_windows_text(spark, d):
    s = doc_samples(spark, d)
    w = win.build_windows(s, vocab_from_samples(s))
    return w.select("sample_id", "window_no", F.md5(ids_str("input_ids")).alias("input_md5"),
                    F.md5(ids_str("target_ids")).alias("target_md5"), arr_sum("loss_mask").alias("mask_sum"))


@register("window_summary", O.with_(O.dialog_turns(), O.dialog_vocab(), O.dialog_ids(), O.windows()) + f"""
SELECT (SELECT count(DISTINCT sample_id) FROM dlg_turns)::BIGINT AS n_dialogs,
       (SELECT count(*) FROM vocab)::BIGINT AS vocab_size,
       (SELECT count(*) FROM ids)::BIGINT AS n_tokens,
       count(DISTINCT (sample_id, window_no))::BIGINT AS n_windows,
       sum(mask)::BIGINT AS mask_sum, sum(id)::BIGINT AS ids_sum
FROM win""")
def q_window_summary(spark, d):
    return flagship(spark, d)


def dialog_windows(spark, d):
    """Windows + vocabulary of ``conversations`` through the skew-safe turn-table plan."""
    return win.turn_table_windows(read_table(spark, d, "conversations"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """How many training windows and supervised tokens does ``conversations`` yield?"""
    from chatloom.functions.text import token_count
    turns = read_table(spark, d, "conversations")
    w, v = win.turn_table_windows(turns)
    # tokens per kept dialog, JVM-side: role token + tokens of the content per turn, one <eos>
    per_turn = F.when(F.col("role").isin("user", "assistant"), 1).otherwise(0) + token_count("text")
    dl = turns.groupBy("conv_id").agg(F.count_if(F.col("role") == "assistant").alias("na"),
                                      F.sum(per_turn).alias("tk")).where("na > 0")
    heads = dl.agg(F.count("*").cast("long").alias("n_dialogs"), F.sum(F.col("tk") + 1).cast("long").alias("n_tokens"))
    stats = w.agg(
        F.count("*").cast("long").alias("n_windows"),
        F.sum(arr_sum("loss_mask")).cast("long").alias("mask_sum"),
        F.sum(arr_sum("input_ids") + F.element_at("target_ids", -1)).cast("long").alias("ids_sum"),
    )
    # one-row aggregates of different inputs, combined by union + max (no join needed)
    parts = [heads, v.agg(F.count("*").cast("long").alias("vocab_size")), stats]
    cols = ["n_dialogs", "vocab_size", "n_tokens", "n_windows", "mask_sum", "ids_sum"]
    u = None
    for p in parts:
        p = p.select(*[(F.col(c) if c in p.columns else F.lit(None).cast("long")).alias(c) for c in cols])
        u = p if u is None else u.unionByName(p)
    return u.agg(*[F.max(c).alias(c) for c in cols])
