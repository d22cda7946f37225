"""JSON items in the three chat dialects, derived by Spark from the turn table.

Each builder groups ``conversations`` by dialog once and renders one item per
dialog (Alpaca: per exchange): ``*_items`` gives ``(ordinal, item struct)`` (for file writers),
``*_records`` gives the records shape a scanned file has: ``(file_path, ordinal, value)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP_NULLS = {"ignoreNullFields": "false"}


def grouped_dialogs(conv: DataFrame) -> DataFrame:
    """(conv_id, t): the turns of each dialog in order.  The builders take this in place of the turn table."""
    return conv.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))


def _grouped(conv: DataFrame) -> DataFrame:
    return conv if conv.columns == ["conv_id", "t"] else grouped_dialogs(conv)


def _texts(role: str):
    return F.filter("t", lambda x: x["role"] == role)


def _first(role: str, k: int = 1):
    return F.try_element_at(_texts(role), F.lit(k))["text"]


def sharegpt_items(conv: DataFrame) -> DataFrame:
    """{system?, conversations: [{from: human|gpt|system, value}]} per dialog."""
    frm = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    convs = F.transform(F.filter("t", lambda x: x["role"] != "system"),
                        lambda x: F.struct(frm(x["role"]).alias("from"), x["text"].alias("value")))
    return _grouped(conv).select(F.col("conv_id").cast("long").alias("ordinal"),
                                 F.struct(F.col("conv_id").cast("long").alias("id"), _first("system").alias("system"),
                                          convs.alias("conversations")).alias("item"))


def moss_items(conv: DataFrame) -> DataFrame:
    """{conversation_id, category, conversation: {turn_N: {Human|MOSS|System: text}}} per dialog."""
    speaker = lambda r: F.when(r == "user", "Human").when(r == "assistant", "MOSS").otherwise("System")
    conversation = F.map_from_entries(F.transform("t", lambda x: F.struct(
        F.concat(F.lit("turn_"), x["turn"].cast("string")).alias("key"),
        F.create_map(speaker(x["role"]), x["text"]).alias("value"))))
    return _grouped(conv).select(
        F.col("conv_id").cast("long").alias("ordinal"),
        F.struct(F.col("conv_id").cast("string").alias("conversation_id"), F.lit("chat").alias("category"),
                 conversation.alias("conversation")).alias("item"))


def exchanges(conv: DataFrame) -> DataFrame:
    """(conv_id, e, system, user, before, assistant): the e-th user and assistant turns of each dialog, side by side.

    ``before`` is the user turn before an even one.  A dialog without either still gives one row.
    """
    n = F.greatest(F.size(_texts("user")), F.size(_texts("assistant")), F.lit(1))
    at = lambda role, k: F.try_element_at(_texts(role), k)["text"]
    e = F.col("e")
    return _grouped(conv).withColumn("e", F.explode(F.sequence(F.lit(1), n))).select(
        "conv_id", "e", _first("system").alias("system"), at("user", e).alias("user"),
        F.when(e % 2 == 0, at("user", F.greatest(e - 1, F.lit(1)))).alias("before"), at("assistant", e).alias("assistant"))


def alpaca_items(conv: DataFrame) -> DataFrame:
    """{system, instruction, input, output} per exchange (nulls kept): ``(ordinal, e, item)``."""
    return exchanges(conv).select(
        F.col("conv_id").cast("long").alias("ordinal"), "e",
        F.struct("system", F.col("user").alias("instruction"), F.col("before").alias("input"),
                 F.col("assistant").alias("output")).alias("item"))


def _records(items: DataFrame, file_path, keep_nulls: bool) -> DataFrame:
    value = F.to_json("item", KEEP_NULLS) if keep_nulls else F.to_json("item")
    path = F.lit(file_path) if isinstance(file_path, str) else file_path
    return items.select(path.alias("file_path"), "ordinal", value.alias("value"))


def sharegpt_records(conv: DataFrame, file_path: str = "conversations.sharegpt.jsonl") -> DataFrame:
    return _records(sharegpt_items(conv), file_path, False)


def moss_records(conv: DataFrame, file_path: str = "conversations.moss.jsonl") -> DataFrame:
    return _records(moss_items(conv), file_path, False)


def alpaca_records(conv: DataFrame, name: str = "conversations.alpaca") -> DataFrame:
    """The e-th exchanges of all dialogs form file ``<name>.<e>.jsonl``; the ordinal is the dialog's id."""
    return _records(alpaca_items(conv), F.concat(F.lit(name + "."), F.col("e").cast("string"), F.lit(".jsonl")), True)
