"""Filter interaction audit: how five quality filters overlap, for each part of a corpus and every filter order.

Each text is judged once by all five filters.  Per part the documents are counted in the 2x2x2x2x2 table of passed
(0) and failed (1) filters; the figures of every step of every order are contractions of that table: one vector an
axis selects the documents that pass, fail, or all of them.  Only narrow rows are shuffled, no text.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import cut, prepare

FILTERS = "ABCDE"
CAPITALS = bytes(range(65, 91))
INNER = bytes(range(0x80, 0xC0))  # bytes that continue a code point
MARKS = b"#$%&*|"
PARTS_AT_ONCE = 256  # parts whose tables a task contracts together
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failed_bits(text: bytes) -> int:
    """The filters A to D that a text fails, as bits 1, 2, 4, 8."""
    words = text.split()  # ASCII white space: 20, 09-0D
    points = len(text.translate(None, INNER))
    return ((len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * (len(text) - len(text.translate(None, CAPITALS))) > 2 * points) << 2
            | (len(text) != len(text.translate(None, MARKS))) << 3)


def _judge_kernel(batches):
    import hashlib

    import pyarrow as pa
    for b in batches:
        bits, digests = [], []
        for t in b.column(2):
            text = t.as_buffer().to_pybytes() if t.is_valid else b""
            bits.append(failed_bits(text))
            digests.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bits, pa.int32()), pa.array(digests, pa.binary())],
                                         names=["doc", "part", "bits", "digest"])


def selectors():
    """``(orders, steps, select)``: select[figure][step] holds a (pass, fail) weight pair for each of the five axes."""
    import numpy as np
    passed, failed, every = (1, 0), (0, 1), (1, 1)
    orders, steps, kept, removed, fails, unique = [], [], [], [], [], []
    for order in permutations(range(5)):
        for s in range(5):
            before, f = order[:s], order[s]
            orders.append("".join(FILTERS[i] for i in order))
            steps.append(s + 1)
            kept.append([passed if i in before or i == f else every for i in range(5)])
            removed.append([failed if i == f else passed if i in before else every for i in range(5)])
            fails.append([failed if i == f else every for i in range(5)])
            unique.append([failed if i == f else passed for i in range(5)])
    return orders, steps, {"kept": np.array(kept), "removed": np.array(removed), "fails": np.array(fails), "unique": np.array(unique)}


def contract(tables, select):
    """``(part, step)`` sums of ``tables`` (part, 2, 2, 2, 2, 2) under the axis weights ``select`` (step, 5, 2)."""
    import numpy as np
    return np.einsum("pabcde,ka,kb,kc,kd,ke->pk", tables, *(select[:, i, :] for i in range(5)), optimize="greedy")


def audit_tables(counts, good, toxic):
    """The figures, each ``(part, 600)`` in the order of ``selectors()``, of the parts' 2x2x2x2x2 tables."""
    import numpy as np
    orders, steps, sel = selectors()
    removed = contract(counts, sel["removed"])
    letter = np.array([FILTERS.index(o[s - 1]) for o, s in zip(orders, steps)])
    per_filter = np.stack([removed[:, letter == f].sum(axis=1) for f in range(5)], axis=1)
    return {"kept": contract(counts, sel["kept"]), "removed": removed, "redundant": contract(counts, sel["fails"]) - removed,
            "unique_fails": contract(counts, sel["unique"]), "good_lost": contract(good, sel["removed"]),
            "toxic_lost": contract(toxic, sel["removed"]), "shapley": per_filter[:, letter]}


def _contract_kernel(batches):
    import numpy as np
    import pyarrow as pa
    orders, steps, _ = selectors()
    for whole in batches:
        for at in range(0, whole.num_rows, PARTS_AT_ONCE):
            b = whole.slice(at, PARTS_AT_ONCE)
            n = b.num_rows
            tables = np.zeros((3, n, 32), dtype=np.int64)
            for p, cells in enumerate(b.column(1).to_pylist()):
                for c in cells:
                    tables[:, p, c["mask"]] = c["n"], c["good"], c["toxic"]
            # bit i of the mask is axis i: C order has the last axis fastest
            tables = tables.reshape(3, n, 2, 2, 2, 2, 2).transpose(0, 1, 6, 5, 4, 3, 2)
            got = audit_tables(*tables)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.repeat(np.arange(n), len(orders)))), pa.array(orders * n), pa.array(steps * n, pa.int32()),
                 *[pa.array(np.ascontiguousarray(got[f], dtype=np.int64).reshape(-1)) for f in FIGURES]],
                names=["part", "filter_order", "step", *FIGURES])


def fail_tables(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "source") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and by the set of filters they fail (bit 0: A ... bit 4: E)."""
    prepare(docs.sparkSession)
    judged = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                         F.col(text_col).alias("text")).mapInArrow(_judge_kernel, "doc long, part string, bits int, digest binary")
    rows = judged.groupBy("doc", "digest", "bits", "part").agg(F.count(F.lit(1)).alias("n"))
    # rows without an id have no label; their digest spreads them over the join's partitions
    spread = F.when(F.col("doc").isNull(), F.col("digest")).otherwise(F.lit(b""))
    if labels is None:
        rows = rows.withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    else:
        known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_doc")).agg(
            F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic"))
        known = known.withColumn("_spread", F.lit(b""))
        rows = rows.withColumn("spread", spread).join(known, (F.col("doc") == F.col("_doc")) & (F.col("spread") == F.col("_spread")), "left") \
            .select("doc", "digest", "bits", "part", "n", F.coalesce("_good", F.lit(0)).alias("good"), F.coalesce("_toxic", F.lit(0)).alias("toxic"))
    # copies are counted before they meet: of a group only its smallest id and the rows with that id matter
    groups = cut(rows.groupBy("digest", "bits", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc").alias("low"), F.coalesce(F.min_by("n", "doc"), F.lit(0)).alias("n_low"),
        F.sum(F.when(F.col("doc").isNull(), F.col("n")).otherwise(0)).alias("n_null")))
    first = groups.groupBy(F.col("digest").alias("_digest")).agg(F.min("low").alias("_first"), F.count(F.lit(1)).alias("_groups")) \
        .where("_groups > 1")
    held = groups.join(first, F.col("digest") == F.col("_digest"), "left")
    firsts = F.when(F.col("low") == F.coalesce("_first", "low"), F.col("n_low")).otherwise(0) + F.col("n_null")
    cells = held.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("bits").alias("mask"), firsts.alias("n")),
        F.struct((F.col("bits") + 16).alias("mask"), (F.col("n") - firsts).alias("n"))))).where("n > 0")
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                             F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step: ``(part, filter_order, step, kept, removed, ...)``.

    Filters fail a text: A under 200 words; B fewer than half of its words distinct; C capitals A-Z over 2 % of its code
    points; D any of ``#$%&*|``; E equal to the text of a smaller id, in any part.  ``kept``, ``removed``: after and by
    the step; ``redundant``: fail its filter but went before; ``unique_fails``: fail no other filter; ``good_lost`` and
    ``toxic_lost``: removed here with that label; ``shapley``: its filter's removals over all 120 orders.

    A null text is empty, a null part the empty string.  A null id has no label, fails E never and makes no other row
    fail it.  Rows that repeat an id are counted each, and are no copies of each other; of labels that repeat an id a 1
    counts.  Without ``labels`` the last two counts are 0.  Extra columns are not read; an empty table gives no rows.
    """
    cells = fail_tables(docs, labels, id_col, text_col, part_col)
    tables = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # at most 32
    longs = ", ".join(f"{f} long" for f in FIGURES)
    return tables.mapInArrow(_contract_kernel, f"part string, filter_order string, step int, {longs}")
