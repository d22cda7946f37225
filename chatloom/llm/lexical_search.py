"""Ranked lexical search: one Aho-Corasick scan of the texts counts the terms of all items; no index of documents.

The items' terms, guarded by a blank on both sides, form one automaton; every text, with all other characters turned
into blanks, runs through it once.  What it finds (document length, term numbers and counts) is frozen; document
frequencies come from there, and a second narrow pass maps terms to items and keeps the best documents a task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import cut, prepare

# terms are runs of 0-9, A-Z (lower-cased), a-z and everything beyond ASCII; all other bytes become blanks
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
BLOCK_BYTES = 16 << 20  # item text per automaton; more items make more automata, each with its own scan
SLICE = 1 << 20  # bytes that run through the automaton at a time
CELLS = 1 << 22  # scores and postings held at a time
LAST = (1 << 63) - 1  # where rows without an id stand


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _automaton(terms: list[bytes]):
    import ahocorasick
    found = ahocorasick.Automaton()
    for no, term in enumerate(terms):
        found.add_word(f" {term.decode('latin-1')} ", no)
    found.make_automaton()
    return found


def _slices(text: bytes):
    """Pieces of a blanked text that start and end with a blank; a term stands in one piece only."""
    text = b" " + text + b" "
    at = 0
    while at < len(text) - 1:
        end = text.find(b" ", at + SLICE) if at + SLICE < len(text) - 1 else len(text) - 1
        yield text[at:end + 1]
        at = end


def _count_terms(automaton, texts: list[bytes], width: int):
    """``(document, term, count)`` arrays of blanked texts, ordered by document and term."""
    import numpy as np
    kind = np.dtype([("end", np.int64), ("term", np.int64)])
    keys, held, ends, size = [], [], [], 0

    def flush():
        nonlocal size
        if held:
            hits = np.fromiter(automaton.iter(b"".join(held).decode("latin-1")), dtype=kind)
            doc = np.array([d for d, _ in ends])[np.searchsorted(np.array([e for _, e in ends]), hits["end"], side="right")]
            key, n = np.unique(doc * width + hits["term"], return_counts=True)
            keys.append((key, n))
        held.clear(), ends.clear()
        size = 0

    for d, t in enumerate(texts):
        for piece in _slices(t):
            held.append(piece)
            size += len(piece)
            ends.append((d, size))
            if size >= SLICE:
                flush()
    flush()
    if not keys:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    key = np.concatenate([k for k, _ in keys])
    n = np.concatenate([n for _, n in keys])
    key, at = np.unique(key, return_inverse=True)
    return key // width, key % width, np.bincount(at, weights=n).astype(np.int64)


def _scan_kernel(terms):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        automaton = None
        for b in batches:
            if automaton is None:
                automaton = _automaton(terms.value)
            texts, sizes = [], []
            for t in b.column(1):
                texts.append(t.as_buffer().to_pybytes().translate(_FOLD) if t.is_valid else b"")
                sizes.append(len(texts[-1].split()))
            doc, term, tf = _count_terms(automaton, texts, max(1, len(terms.value)))
            sizes = np.array(sizes, dtype=np.int64)
            keep = np.flatnonzero(sizes)
            offsets = np.searchsorted(doc, np.append(keep, len(texts))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep)), pa.array(sizes[keep]), pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))], names=["doc", "n", "terms", "tfs"])
    return run


class Items:
    """A block of items: its terms in order, and for each term the items that hold it, with their counts."""

    def __init__(self, rows):
        import numpy as np
        from collections import Counter
        held = [(item_id, Counter(terms_of((text or "").encode("utf-8")))) for item_id, text in rows]
        self.ids = [item_id for item_id, c in held if c]
        held = [c for _, c in held if c]
        self.terms = sorted({t for c in held for t in c})
        number = {t: i for i, t in enumerate(self.terms)}
        posts = sorted((number[t], i, n) for i, c in enumerate(held) for t, n in c.items())
        self.item = np.array([p[1] for p in posts], dtype=np.int64)
        self.times = np.array([p[2] for p in posts], dtype=np.int64)
        self.start = np.searchsorted(np.array([p[0] for p in posts], dtype=np.int64), np.arange(len(self.terms) + 1))
        self.weight = None

    def weigh(self, n_docs: int, df: dict[int, int]) -> None:
        import numpy as np
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(self.terms))],
                               dtype=np.int64)
        per_term = np.repeat(self.weight, np.diff(self.start)) * self.times
        top = np.bincount(self.item, weights=per_term, minlength=len(self.ids)).max(initial=0) * 1e6
        self.exact_in_doubles = bool(top < 2 ** 53)  # a term's count part is below 1,000,000

    def scores(self, docs, terms, parts, n: int):
        """``(n, items)`` int64 scores from the count parts of (document, term) pairs."""
        import numpy as np
        size = self.start[terms + 1] - self.start[terms]
        at = np.repeat(self.start[terms] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        cell = np.repeat(docs, size) * len(self.ids) + self.item[at]
        worth = np.repeat(self.weight[terms] * parts, size) * self.times[at]
        if self.exact_in_doubles:
            out = np.bincount(cell, weights=worth, minlength=n * len(self.ids)).astype(np.int64)
        else:
            out = np.zeros(n * len(self.ids), dtype=np.int64)
            np.add.at(out, cell, worth)
        return out.reshape(n, len(self.ids))


def _best(item, doc, score, k: int):
    """The first k of each item, by score, then by id."""
    import numpy as np
    order = np.lexsort((doc, -score, item))
    item, doc, score = item[order], doc[order], score[order]
    first = np.searchsorted(item, item)
    keep = np.arange(len(item)) - first < k
    return item[keep], doc[keep], score[keep]


def _chunks(sizes, width: int):
    """Runs of documents whose scores and postings stay within ``CELLS`` (or a single document)."""
    at, held = 0, 0
    for i, s in enumerate(sizes):
        if i > at and (held + s > CELLS or (i - at + 1) * width > CELLS):
            yield at, i
            at, held = i, 0
        held += s
    if at < len(sizes):
        yield at, len(sizes)


def _rank_kernel(items, n_docs: int, n_terms: int, k: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        block = items.value
        width = len(block.ids)
        best = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
        floor = np.ones(width, dtype=np.int64)  # the least score that may still rank
        for b in batches:
            ids = b.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
            size = b.column(1).to_numpy(zero_copy_only=False)
            ends = b.column(2).offsets.to_numpy().astype(np.int64)
            terms = b.column(2).values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]].astype(np.int64)
            lists = b.column(3).offsets.to_numpy()
            tf = b.column(3).values.to_numpy(zero_copy_only=False)[lists[0]:lists[-1]].astype(np.int64)
            ends -= ends[0]
            if int(size.max(initial=0)) * 75 * n_docs < 1 << 63:
                m = 25 + (75 * size * n_docs) // n_terms
            else:
                m = np.array([25 + 75 * int(x) * n_docs // n_terms for x in size], dtype=np.int64)
            parts = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(ends)))
            posts = np.concatenate([[0], np.cumsum(block.start[terms + 1] - block.start[terms])])
            for a, z in _chunks(np.diff(posts[ends]), width):
                part = slice(ends[a], ends[z])
                doc = np.repeat(np.arange(z - a), np.diff(ends[a:z + 1]))
                got = block.scores(doc, terms[part], parts[part], z - a)
                least = np.maximum(floor, np.partition(got, z - a - k, axis=0)[z - a - k]) if z - a > k else floor
                d, i = np.nonzero(got >= least)
                best = _best(*(np.concatenate(x) for x in zip(best, (i, ids[a:z][d], got[d, i]))), k)
                full = np.bincount(best[0], minlength=width) >= k
                lowest = np.full(width, LAST)
                np.minimum.at(lowest, best[0], best[2])
                floor = np.where(full, lowest, 1)
        if len(best[0]):
            doc = pa.array(best[1], mask=best[1] == LAST)
            yield pa.RecordBatch.from_arrays([pa.array(best[0]), doc, pa.array(best[2])], names=["item", "doc_id", "score"])
    return run


def _blocks(items: DataFrame, item_col: str, item_text_col: str, block_bytes: int):
    """Yield the items in blocks of about ``block_bytes`` bytes of text."""
    src = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where("text is not null")
    n = -(-int(src.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    for i in range(n):
        block = Items([tuple(r) for r in src.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()])
        if block.ids:
            yield block


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents with a score above 0 for each item, from rank 1.

    Terms are maximal runs of ASCII digits and letters (A-Z lower-cased) and characters beyond ASCII, in whole texts.
    With N documents that have a term, L terms in all, n in a document, df documents with a term and tf its count there:
    w = floor(1000 ln((2N+2)/(2df+1))), m = 25 + 75nN div L, and a document scores w * (10^9 tf div (1000 tf + 8m))
    summed over the item's terms, repeats included.  Equal scores rank by ascending id, a null id last.

    Null, empty and term-less texts and items rank nowhere; rows that repeat an id are documents of their own, rows
    that repeat an item items of their own; an empty table gives no rows; extra columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for no, block in enumerate(_blocks(items, item_col, item_text_col, block_bytes)):
        terms = spark.sparkContext.broadcast(block.terms)
        found = cut(src.mapInArrow(_scan_kernel(terms), "doc long, n long, terms array<int>, tfs array<int>"))
        terms.unpersist()
        n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            return out
        df = found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # at most the block's terms
        block.weigh(n_docs, {r["term"]: r["count"] for r in df})
        shared = spark.sparkContext.broadcast(block)
        ranked = found.mapInArrow(_rank_kernel(shared, n_docs, n_terms, k), "item long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        names = spark.createDataFrame(list(enumerate(block.ids)), "_item long, item_id long")
        best = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
            .join(F.broadcast(names), F.col("item") == F.col("_item"))
        out = out.unionByName(best.select("item_id", "rank", "doc_id", "score"))
    return out
