"""Chat-dialect normalizers over JSON records, with a quarantine.

Input to every normalizer is a *records* frame ``(file_path, ordinal, value)``
where ``value`` is the JSON text of one item.  Output is ``Normalized(samples,
quarantine)``: both are plain projections/filters of the input — no shuffle.

Each record is parsed once into a VARIANT (``_v``; scanners pass theirs along)
and every field is extracted from it.  Key *presence* (the reference tests
``"k" in item``) is ``variant_get(v, '$.k') IS NOT NULL``: a JSON ``null`` is a
variant null, not SQL NULL, so missing and null stay distinct.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.sources.tables import conform

MAP_SS = "map<string,string>"


class Normalized(NamedTuple):
    samples: DataFrame
    quarantine: DataFrame


def _has(keys: Column, k: str) -> Column:
    """Key presence in a ``json_object_keys`` array (used by format detection)."""
    return F.coalesce(F.array_contains(keys, k), F.lit(False))


def _variant(records: DataFrame) -> Column:
    return F.col("_v") if "_v" in records.columns else F.try_parse_json("value")


# A VARIANT holds at most ~128 MB; a larger record is still valid JSON.  For such rows
# (``_v`` NULL while the text is an object) fields come from ``from_json`` over the text,
# with Jackson's string-length guard lifted.  CASE evaluates the fallback only for them.
BIG_JSON = {"maxStringLen": str(2**31 - 1)}


def _big(k: str, typ: str) -> Column:
    return F.from_json(F.col("value"), f"struct<`{k}`:{typ}>", BIG_JSON)[k]


def _present(v: Column, k: str) -> Column:
    return F.when(v.isNotNull(), F.variant_get(v, f"$.{k}", "variant").isNotNull()) \
        .otherwise(F.array_contains(F.json_object_keys("value"), k))


def _str(v: Column, k: str) -> Column:
    return F.when(v.isNotNull(), F.try_variant_get(v, f"$.{k}", "string")).otherwise(_big(k, "string"))


def _get(v: Column, k: str, typ: str) -> Column:
    return F.when(v.isNotNull(), F.try_variant_get(v, f"$.{k}", typ)).otherwise(_big(k, typ))


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def _turn(role, content) -> Column:
    return F.struct(F.lit(role).alias("role") if isinstance(role, str) else role.alias("role"),
                    content.alias("content"))


def _file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def _ids(df: DataFrame) -> DataFrame:
    return df.withColumn("sample_id", F.sha2(F.concat_ws(":", "file_path", F.col("ordinal").cast("string")), 256))


def _split(df: DataFrame, reason: Column, sample_cols: list[Column]) -> Normalized:
    """One pass: rows with a NULL reason become samples, the others go to quarantine."""
    tagged = df.withColumn("_reason", reason)
    good = tagged.where(F.col("_reason").isNull()).select("file_path", "ordinal", *sample_cols)
    bad = tagged.where(F.col("_reason").isNotNull()).select(
        "file_path", F.col("ordinal").cast("long"), F.col("value").alias("raw"), F.col("_reason").alias("reason"))
    return Normalized(conform(_ids(good)), bad)


def _null_content(dialog: Column) -> Column:
    return F.exists(dialog, lambda t: t["content"].isNull())


def _base_reason(v: Column) -> Column:
    return F.when(v.isNull() & F.json_object_keys("value").isNull(), F.lit("bad_json"))


# -- B1 MOSS ---------------------------------------------------------------------------------------------
EMPTY_DIALOG = "array<struct<role:string,content:string>>"


def _parsed(records: DataFrame) -> DataFrame:
    """(file_path, ordinal, value, _v): one JSON parse per record (reused when the scanner has one)."""
    return records.select("file_path", "ordinal", "value", _variant(records).alias("_v"))


def normalize_moss(records: DataFrame, turn_order: str = "numeric") -> Normalized:
    """B1: ``conversation`` object; ``turn_*`` keys in order; Human -> user, MOSS -> assistant.

    ``turn_order='numeric'`` sorts turn_2 before turn_10; ``'lexical'`` sorts as strings
    (the reference's order).
    """
    vv = F.col("_v")
    base = _parsed(records).withColumn("_conv", _get(vv, "conversation", f"map<string,{MAP_SS}>"))
    conv = F.col("_conv")
    names = F.filter(F.map_keys(conv), lambda k: k.startswith("turn_"))
    if turn_order == "numeric":
        # numbers of any length: the one with fewer digits is less, equally long ones compare as strings
        digits = lambda k: F.regexp_extract(k, r"^turn_0*(\d+)$", 1)
        keyed = F.transform(names, lambda k: F.struct(
            F.when(digits(k) == "", 1).otherwise(0).alias("nonnum"),
            F.char_length(digits(k)).alias("length"), digits(k).alias("n"), k.alias("k")))
    elif turn_order == "lexical":
        keyed = F.transform(names, lambda k: F.struct(k.alias("k")))
    else:
        raise ValueError("turn_order is 'numeric' or 'lexical'")
    empty = F.array().cast(EMPTY_DIALOG)
    dialog = F.flatten(F.transform(F.array_sort(keyed), lambda e: F.concat(
        F.when(F.map_contains_key(conv[e["k"]], "Human"), F.array(_turn("user", conv[e["k"]]["Human"]))).otherwise(empty),
        F.when(F.map_contains_key(conv[e["k"]], "MOSS"), F.array(_turn("assistant", conv[e["k"]]["MOSS"]))).otherwise(empty),
    )))
    df = base.withColumn("dialog", dialog)
    n_asst = F.size(F.filter("dialog", lambda t: t["role"] == "assistant"))
    reason = _base_reason(vv) \
        .when(~F.coalesce(_present(vv, "conversation"), F.lit(False)), F.lit("missing_key")) \
        .when(conv.isNull(), F.lit("bad_item")) \
        .when(n_asst == 0, F.lit("no_assistant")) \
        .when(_null_content(F.col("dialog")), F.lit("null_content"))
    cid = F.when(_present(vv, "conversation_id"),
                 F.coalesce(_str(vv, "conversation_id"), F.lit("None"))).otherwise("unknown")
    cat = F.when(_present(vv, "category"), _str(vv, "category")).otherwise("unknown")
    return _split(df, reason, [
        F.lit("dialog").alias("kind"), "dialog",
        F.concat(_file_name(F.col("file_path")), F.lit(":"), cid).alias("source"),
        F.lit("sft").alias("type"), n_asst.alias("turns"), cat.alias("category"), F.lit("moss").alias("format"),
    ])


# -- B2 ShareGPT -------------------------------------------------------------------------------------------
# fixed values: ShareGPT speaker names
SHAREGPT_ROLES = {"human": "user", "user": "user", "gpt": "assistant", "assistant": "assistant",
                  "bot": "assistant", "system": "system"}


def _sgpt_role(frm: Column) -> Column:
    expr = None
    for name, role in SHAREGPT_ROLES.items():
        expr = F.when(frm == name, F.lit(role)) if expr is None else expr.when(frm == name, F.lit(role))
    return expr


def normalize_sharegpt(records: DataFrame) -> Normalized:
    """B2: ``conversations`` list of {from, value}; truthy top-level ``system`` first; unknown speakers dropped."""
    vv = F.col("_v")
    base = _parsed(records).select(
        "*", _get(vv, "conversations", f"array<{MAP_SS}>").alias("_convs"),
        _str(vv, "system").alias("_system"))
    system = F.col("_system")
    msgs = F.transform("_convs", lambda c: F.struct(
        _sgpt_role(F.coalesce(c["from"], F.lit(""))).alias("role"),
        F.when(F.map_contains_key(c, "value"), c["value"]).otherwise(F.lit("")).alias("content")))
    msgs = F.filter(msgs, lambda t: t["role"].isNotNull())
    dialog = F.concat(
        F.when(_truthy(system), F.array(_turn("system", system))).otherwise(F.array().cast(EMPTY_DIALOG)),
        msgs)
    df = base.withColumn("dialog", dialog)
    n_asst = F.size(F.filter("dialog", lambda t: t["role"] == "assistant"))
    reason = _base_reason(vv) \
        .when(~F.coalesce(_present(vv, "conversations"), F.lit(False)), F.lit("missing_key")) \
        .when(F.col("_convs").isNull(), F.lit("bad_item")) \
        .when(n_asst == 0, F.lit("no_assistant")) \
        .when(_null_content(F.col("dialog")), F.lit("null_content"))
    return _split(df, reason, [
        F.lit("dialog").alias("kind"), "dialog",
        F.concat(_file_name(F.col("file_path")), F.lit(":"), F.col("ordinal").cast("string")).alias("source"),
        F.lit("sft").alias("type"), n_asst.alias("turns"), F.lit("sharegpt").alias("format"),
    ])


# -- B3 Alpaca -----------------------------------------------------------------------------------------------
def normalize_alpaca(records: DataFrame) -> Normalized:
    """Instruction (+ newline + truthy input) -> user, output -> assistant; truthy system first."""
    vv = F.col("_v")
    base = _parsed(records).select("*", *[_str(vv, k).alias(f"_{k}") for k in ("instruction", "input", "output",
                                                                                "system")])
    ins, inp, out, system = F.col("_instruction"), F.col("_input"), F.col("_output"), F.col("_system")
    user = F.when(_truthy(inp), F.concat(ins, F.lit("\n"), inp)).otherwise(ins)
    dialog = F.concat(
        F.when(_truthy(system), F.array(_turn("system", system))).otherwise(F.array().cast(EMPTY_DIALOG)),
        F.array(_turn("user", user), _turn("assistant", out)))
    df = base.withColumn("dialog", dialog)
    has = F.coalesce(_present(vv, "instruction") & _present(vv, "output"), F.lit(False))
    reason = _base_reason(vv) \
        .when(~has, F.lit("missing_key")) \
        .when(_null_content(F.col("dialog")), F.lit("null_content"))
    return _split(df, reason, [
        F.lit("dialog").alias("kind"), "dialog",
        F.concat(_file_name(F.col("file_path")), F.lit(":"), F.col("ordinal").cast("string")).alias("source"),
        F.lit("sft").alias("type"), F.lit("alpaca").alias("format"),
    ])


# -- B6 ---------------------------------------------------------------------------------------------------------
def keep_answered_dialogs(samples: DataFrame) -> DataFrame:
    """Dialogs with at least one assistant turn (texts pass through); ``turns`` = #assistant."""
    n = F.size(F.filter("dialog", lambda t: t["role"] == "assistant"))
    return samples.where((F.col("kind") != "dialog") | (n > 0)) \
        .withColumn("turns", F.when(F.col("kind") == "dialog", n).otherwise(F.col("turns")))


def answered_dialogs(turns: DataFrame, id_col: str = "conv_id", role_col: str = "role") -> DataFrame:
    """B6 over a turn table: ``(id, n_msgs, turns)`` of dialogs with an assistant turn; reads two columns, no text."""
    return turns.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_msgs"),
                                     F.count_if(F.col(role_col) == "assistant").alias("turns")).where("turns > 0")


# -- B4 / K1 registry ----------------------------------------------------------------------------------------------
class FormatSpec(NamedTuple):
    name: str
    detect: Callable[[Column], Column] | None   # keys array<string> of the first record -> boolean
    normalize: Callable[[DataFrame], Normalized] | None


_REGISTRY: dict[str, FormatSpec] = {}


def register_format(name: str, detect: Callable[[Column], Column] | None, normalize: Callable[[DataFrame], Normalized] | None) -> None:
    """K1: add a dialect.  ``normalize`` maps a records frame to ``Normalized``."""
    _REGISTRY[name] = FormatSpec(name, detect, normalize)


def unregister_format(name: str) -> None:
    _REGISTRY.pop(name, None)


def formats() -> dict[str, FormatSpec]:
    return dict(_REGISTRY)


def load_format(records: DataFrame, fmt: str) -> Normalized:
    """Named format -> its normalizer; unknown names (and declared-only 'openai') raise."""
    spec = _REGISTRY.get(fmt)
    if spec is None or spec.normalize is None:
        raise ValueError(f"unknown format: {fmt}")
    return spec.normalize(records)


# detection precedence of the first record's keys: conversation -> moss, conversations -> sharegpt,
# instruction -> alpaca (registration order is the precedence)
register_format("moss", lambda k: _has(k, "conversation"), normalize_moss)
register_format("sharegpt", lambda k: _has(k, "conversations"), normalize_sharegpt)
register_format("alpaca", lambda k: _has(k, "instruction"), normalize_alpaca)
register_format("openai", None, None)
