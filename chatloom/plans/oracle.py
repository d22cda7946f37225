"""DuckDB SQL oracles: the same questions answered by plain SQL over the raw tables.

Fragments are composed into ``WITH`` chains.  They spell each operator's
semantics independently of the Spark code (joins and window functions instead
of Arrow kernels), so a match is a real cross-check.
"""

from __future__ import annotations

from chatloom.schema import PY_WHITESPACE, SPECIAL_TOKENS

S = 256
STRIDE = 128
SPECIALS = "[" + ", ".join(f"'{t}'" for t in SPECIAL_TOKENS) + "]"
TOKEN_RE = "(?s)" + "|".join(SPECIAL_TOKENS) + "|."


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# -- dialog samples from the turn table -------------------------------------------------------
def dialog_turns(kept: bool = True) -> str:
    where = "WHERE conv_id IN (SELECT conv_id FROM conversations WHERE role = 'assistant')" if kept else ""
    return f"""dlg_turns AS (
  SELECT 'conversations:' || conv_id AS sample_id, turn, role, text AS content
  FROM conversations {where}
)"""


def doc_texts() -> str:
    return """doc_texts AS (
  SELECT 'documents:' || doc_id AS sample_id, text FROM documents
)"""


# -- vocabulary ---------------------------------------------------------------------------------
def dialog_vocab(name: str = "vocab") -> str:
    """Characters of contents and of the role markers in use, plus <eos> and newline."""
    return f"""{name}_chars AS (
  SELECT DISTINCT unnest(regexp_extract_all(content, '(?s).')) AS token FROM dlg_turns
  UNION
  SELECT DISTINCT unnest(regexp_extract_all(CASE role WHEN 'user' THEN '<user>' WHEN 'assistant' THEN '<assistant>'
                                            WHEN 'system' THEN '<system>' END, '(?s).')) FROM dlg_turns
  UNION
  SELECT unnest(regexp_extract_all('<eos>' || chr(10), '(?s).')) FROM (SELECT 1 FROM dlg_turns LIMIT 1)
),
{name} AS (
  SELECT unnest({SPECIALS}) AS token, unnest(range(7))::INTEGER AS id, true AS is_special
  UNION ALL
  SELECT token, (6 + row_number() OVER (ORDER BY token))::INTEGER AS id, false AS is_special FROM {name}_chars
)"""


def text_vocab(name: str = "dvocab", src: str = "doc_texts") -> str:
    return f"""{name}_chars AS (
  SELECT DISTINCT unnest(regexp_extract_all(text, '(?s).')) AS token FROM {src}
  UNION
  SELECT unnest(regexp_extract_all('<eos>' || chr(10), '(?s).')) FROM (SELECT 1 FROM {src} LIMIT 1)
),
{name} AS (
  SELECT unnest({SPECIALS}) AS token, unnest(range(7))::INTEGER AS id, true AS is_special
  UNION ALL
  SELECT token, (6 + row_number() OVER (ORDER BY token))::INTEGER AS id, false AS is_special FROM {name}_chars
)"""


# -- encoding ------------------------------------------------------------------------------------
def dialog_ids(vocab: str = "vocab", name: str = "ids", with_ord: bool = False) -> str:
    """(sample_id, pos, id): role token + content tokens per turn, one <eos> at the end
    (``with_ord``: plus the turn key ``ord``, the largest BIGINT for the <eos>)."""
    ord_col = "t.ord, " if with_ord else ""
    return f"""{name}_pieces AS (
  SELECT sample_id, turn AS ord,
         (CASE role WHEN 'user' THEN ['<user>'] WHEN 'assistant' THEN ['<assistant>'] ELSE []::VARCHAR[] END)
         || regexp_extract_all(content, {_q(TOKEN_RE)}) AS lst
  FROM dlg_turns
  UNION ALL
  SELECT DISTINCT sample_id, 9223372036854775807 AS ord, ['<eos>'] AS lst FROM dlg_turns
),
{name}_tok AS (
  SELECT sample_id, ord, generate_subscripts(lst, 1) AS k, unnest(lst) AS tk FROM {name}_pieces
),
{name} AS (
  SELECT {ord_col}t.sample_id, row_number() OVER (PARTITION BY t.sample_id ORDER BY t.ord, t.k) - 1 AS pos,
         coalesce(v.id, 1) AS id
  FROM {name}_tok t LEFT JOIN {vocab} v ON v.token = t.tk
)"""


def text_ids(vocab: str = "dvocab", src: str = "doc_texts", name: str = "tids", eos: bool = True) -> str:
    eos_sql = f"""
  UNION ALL
  SELECT sample_id, 2 AS ord, ['<eos>'] AS lst FROM {src}""" if eos else ""
    return f"""{name}_pieces AS (
  SELECT sample_id, 1 AS ord, regexp_extract_all(text, {_q(TOKEN_RE)}) AS lst FROM {src}{eos_sql}
),
{name}_tok AS (
  SELECT sample_id, ord, generate_subscripts(lst, 1) AS k, unnest(lst) AS tk FROM {name}_pieces
),
{name} AS (
  SELECT t.sample_id, row_number() OVER (PARTITION BY t.sample_id ORDER BY t.ord, t.k) - 1 AS pos,
         coalesce(v.id, 1) AS id
  FROM {name}_tok t LEFT JOIN {vocab} v ON v.token = t.tk
)"""


# -- windows ---------------------------------------------------------------------------------------
def windows(ids: str = "ids", name: str = "win", seq_len: int = S, stride: int = STRIDE) -> str:
    """(sample_id, window_no, off, id, mask) for off in 0..S; pads are 0; mask only for off < S."""
    return f"""{name}_lens AS (SELECT sample_id, count(*) AS L FROM {ids} GROUP BY sample_id),
{name}_starts AS (
  SELECT sample_id, L, unnest(CASE WHEN L <= {seq_len + 1} THEN [0] ELSE range(0, L - {seq_len}, {stride}) END) AS start
  FROM {name}_lens
),
{name}_slots AS (
  SELECT sample_id, L, start, (start // {stride})::INTEGER AS window_no, unnest(range(0, {seq_len + 1})) AS off
  FROM {name}_starts
),
{name}_tok AS (
  SELECT s.sample_id, s.window_no, s.start, s.L, s.off, coalesce(i.id, 0) AS id
  FROM {name}_slots s LEFT JOIN {ids} i ON i.sample_id = s.sample_id AND i.pos = s.start + s.off
),
{name} AS (
  SELECT sample_id, window_no, start, L, off, id,
         CASE WHEN off < {seq_len} AND id <> 5 AND coalesce(last_value(CASE WHEN off < {seq_len} THEN
                CASE id WHEN 5 THEN 1 WHEN 4 THEN 0 WHEN 3 THEN 0 END END IGNORE NULLS)
              OVER (PARTITION BY sample_id, window_no ORDER BY off ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 1
              THEN 1 ELSE 0 END AS mask
  FROM {name}_tok
)"""


def with_(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


PY_WS_SQL = _q(PY_WHITESPACE)
