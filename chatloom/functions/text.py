"""Built-in (JVM-side) column expressions shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.schema import PY_WHITESPACE, ROLE_MARKERS, SPECIAL_TOKENS

# one code point per match; special strings first so they win at their position
CHAR_PATTERN = "(?s)."
TOKEN_PATTERN = "(?s)" + "|".join(SPECIAL_TOKENS) + "|."


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_points(c) -> Column:
    """array<string> of the code points of a string."""
    return F.regexp_extract_all(col_(c), F.lit(CHAR_PATTERN), 0)


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.trim(col_(c), F.lit(PY_WHITESPACE))


def role_marker(role: Column) -> Column:
    """Corpus marker of a role; NULL for roles without one."""
    expr = None
    for r, m in ROLE_MARKERS.items():
        expr = (F.when(role == r, F.lit(m))) if expr is None else expr.when(role == r, F.lit(m))
    return expr


def sql_str(s: str) -> str:
    """SQL string literal (single quotes doubled)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def token_count(c) -> Column:
    """Tokens of a string under the special-token scan, without a per-character regex.

    Specials never overlap (each starts with '<' and contains no other '<'), so each
    occurrence of a special of length n replaces n code points by one token:
    tokens = code points − Σ occurrences × (n − 1).
    """
    c = col_(c)
    n = F.char_length(c)
    for t in SPECIAL_TOKENS:
        occ = (F.char_length(c) - F.char_length(F.replace(c, F.lit(t), F.lit("")))) / F.lit(len(t))
        n = n - occ.cast("long") * (len(t) - 1)
    return F.coalesce(n, F.lit(0)).cast("long")
