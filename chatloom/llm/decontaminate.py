"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit check.

Texts are words (A-Z lower-cased runs of letters, digits and non-ASCII bytes).  The CGK random walk copies
the current word to output places and moves on or stays by a random bit of (place, word), so
that few word edits become few differing places; sampled ones of the first ``2 * L`` places are the LSH key, repeated with
new walks until the recall target is met on mutated items of each length.  Lengths that ``MAX_WALKS`` walks don't bring there
do without keys: all their windows are verified.  Windows have the item's size and stand where a
shared word run puts them; an item with d edits in L words still shares ``L - q + 1 - q * d`` runs of q words, so
the windows left out can't match.  What collides is verified by exact edit distance.
The benchmark is the query set: it is read in blocks of bounded size, each broadcast to one pass over the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.charlm import HashArray
from chatloom.llm.common import prepare

BLOCK_CHARS = 8_000_000  # benchmark characters that are broadcast at a time
PIECE = 1 << 16          # bytes of a text whose words are hashed at a time
SAMPLED = 2              # output places of the walk that make a key
MAX_WALKS = 96           # walks of a length; beyond, every window is verified
MUTATED = 100            # mutated items of each length, at least, that the number of walks is fitted on
_M = (1 << 64) - 1


def _mix(z):
    import numpy as np
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


_TABLES = None


def _byte_tables():
    """(value of each byte, 0 for separators; powers of an odd number; their inverses)."""
    global _TABLES
    if _TABLES is None:
        import numpy as np
        low = bytes(range(256)).lower()
        word = np.array([0x80 <= c or chr(c).isalnum() for c in low])
        value = _mix(np.frombuffer(low, np.uint8).astype(np.uint64) + np.uint64(1)) * word
        odd, size = 0x9E3779B97F4A7C15, PIECE + 1
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(size, odd, dtype=np.uint64))
            inverse = np.cumprod(np.full(size, pow(odd, -1, 1 << 64), dtype=np.uint64))
        _TABLES = value, powers, inverse
    return _TABLES


def word_hashes(data):
    """64-bit hashes of the words of UTF-8 bytes (a numpy array), in order.

    A word's hash is the difference of two running sums of byte value * power, brought back to its start.
    Pieces end behind a separator; only a word that is longer than a piece is hashed by parts.
    """
    import numpy as np
    value, powers, inverse = _byte_tables()
    out, carry, pos = [], None, 0
    while pos < len(data):
        v = value[data[pos:pos + PIECE]]
        more = pos + len(v) < len(data)
        if more and v[-1]:
            blanks = np.flatnonzero(v == 0)
            v = v[:blanks[-1] + 1] if len(blanks) else v
        pos += len(v)
        inside = np.zeros(len(v) + 2, dtype=np.int8)
        inside[1:-1] = v != 0
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edge[::2], edge[1::2]
        with np.errstate(over="ignore"):
            total = np.zeros(len(v) + 1, dtype=np.uint64)
            np.cumsum(v * powers[:len(v)], out=total[1:])
            h = _mix((total[ends] - total[starts]) * inverse[starts] + np.uint64(1))
            if carry is not None:
                if len(starts) and starts[0] == 0:
                    h[0] = _mix(h[0] + carry[0] * np.uint64(0xD6E8FEB86659FD93))
                else:
                    out.append(carry)
                carry = None
        if more and v[-1]:
            carry, h = h[-1:], h[:-1]
        out.append(h)
    if carry is not None:
        out.append(carry)
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def run_hashes(words, q: int):
    """Hashes of every run of q words."""
    import numpy as np
    n = len(words) - q + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, dtype=np.uint64)
        for i in range(q):
            h = h * np.uint64(0xD6E8FEB86659FD93) + words[i:i + n]
        return _mix(h)


def cgk_keys(windows, walk: int):
    """LSH keys of equally long windows (rows of word hashes) under one random walk."""
    import numpy as np
    n, size = windows.shape
    sampled = sorted(int(x) for x in np.random.RandomState(1000 + walk).choice(2 * size, min(SAMPLED, 2 * size), replace=False))
    at, rows, key = np.zeros(n, dtype=np.int64), np.arange(n), np.full(n, np.uint64(size))
    with np.errstate(over="ignore"):
        for j in range(sampled[-1] + 1):
            sym = np.where(at < size, windows[rows, np.minimum(at, size - 1)], np.uint64(0))
            if j in sampled:
                key = _mix(key * np.uint64(0xD6E8FEB86659FD93) + sym + np.uint64(j))
            seed = np.uint64((walk * 0x9E3779B97F4A7C15 + j * 0xC2B2AE3D27D4EB4F + 1) & _M)
            at += (_mix(sym + seed) & np.uint64(1)).astype(np.int64)
        return _mix(key + np.uint64(walk))


def edit_distance_within(item, region) -> tuple[int, int]:
    """(least edits between the item and any run of the region's words, where the best run ends)."""
    import numpy as np
    n = len(region)
    steps = np.arange(n + 1)
    row = np.zeros(n + 1, dtype=np.int64)  # a run may start anywhere
    for i, w in enumerate(item, 1):
        new = np.empty(n + 1, dtype=np.int64)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (region != w), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min()), int(row.argmin())


def allowed_edits(size: int, similarity: float) -> int:
    return int(size * (1 - similarity) + 1e-9)


def run_size(size: int, edits: int) -> int:
    """The longest q up to 3 of which a match must share at least one run."""
    return next((q for q in (3, 2) if size - q + 1 - q * edits >= 1), 1)


class Block:
    """A block of items: run postings, LSH keys and, by length, as many walks as reach the recall target."""

    def __init__(self, items, similarity: float, recall: float):
        import numpy as np
        self.similarity = similarity
        self.items = [(i, w) for i, w in items if len(w)]
        self.size = np.array([len(w) for _, w in self.items], dtype=np.int64)
        self.edits = np.array([allowed_edits(n, similarity) for n in self.size], dtype=np.int64)
        q = np.array([run_size(n, d) for n, d in zip(self.size, self.edits)], dtype=np.int64)
        self.need = np.maximum(1, self.size - q + 1 - q * self.edits)
        self.runs = {}
        for k in sorted(set(q.tolist())):
            own = [(run_hashes(self.items[i][1], k), i) for i in np.flatnonzero(q == k)]
            h = np.concatenate([a for a, _ in own])
            item = np.concatenate([np.full(len(a), i) for a, i in own])
            off = np.concatenate([np.arange(len(a)) for a, _ in own])
            order = np.argsort(h, kind="stable")
            keys, first, count = np.unique(h[order], return_index=True, return_counts=True)
            self.runs[k] = (HashArray(keys), first, count, item[order], off[order])
        self.keys = {}  # by length: a table a walk, or None where every window is verified
        for n in sorted(set(self.size.tolist())):
            own = np.flatnonzero(self.size == n)
            rows = np.array([self.items[i][1] for i in own])
            walks = self._walks(rows, int(self.edits[own[0]]), recall)
            self.keys[n] = None if walks is None else [dict() for _ in range(walks)]
            for walk in range(walks or 0):
                for i, k in zip(own.tolist(), cgk_keys(rows, walk).tolist()):
                    self.keys[n][walk].setdefault(k, set()).add(i)

    @staticmethod
    def _walks(rows, d: int, recall: float) -> int | None:
        """Fewest walks that find ``recall`` of equally long items with ``d`` random word edits; None if too many."""
        import numpy as np
        if not d:
            return 1
        rng = np.random.RandomState(5)
        n = rows.shape[1]
        kept = np.repeat(rows, -(-MUTATED // len(rows)), axis=0)
        made = np.empty_like(kept)
        for r, word in enumerate(kept):
            new = list(word)
            for _ in range(d):
                kind, at = rng.randint(3), rng.randint(max(1, len(new)))
                new[at:at + (kind != 1)] = [] if kind == 0 else [np.uint64(rng.randint(1, 1 << 62))]
            made[r] = (new + [np.uint64(rng.randint(1, 1 << 62)) for _ in range(n)])[:n]
        open_ = np.arange(len(kept))
        for walk in range(MAX_WALKS):
            keys = cgk_keys(np.concatenate([kept[open_], made[open_]]), walk)
            open_ = open_[keys[:len(open_)] != keys[len(open_):]]
            if len(open_) <= (1 - recall) * len(kept) + 1e-9:
                return walk + 1
        return None

    def matches(self, words, docs):
        """``words``: hashes of several texts in a row; ``docs``: where each text begins, and the end.

        Returns {(text, item): (edits, first word, words)}, the best place of each item in each text.
        """
        import numpy as np
        hits = []
        owner_end = docs[1:]
        for q, (index, first, count, item, off) in self.runs.items():
            pos = index.find(run_hashes(words, q))
            at = np.flatnonzero(pos >= 0)
            if not len(at):
                continue
            doc = np.searchsorted(owner_end, at, side="right")
            ok = at + q <= owner_end[doc]  # not across texts
            at, doc = at[ok], doc[ok]
            p = pos[at]
            n = count[p]
            flat = np.repeat(first[p] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            hits.append(np.stack([np.repeat(doc, n), item[flat], np.repeat(at, n), off[flat]]))
        if not hits:
            return {}
        doc, item, at, off = np.concatenate(hits, axis=1)
        # every window needs its number of shared runs in reach: distinct places of the text that hit the item
        pair = doc * np.int64(len(self.items)) + item
        stride = np.int64(len(words) + 1)
        places = np.unique(pair * stride + at)
        wins = np.unique(np.stack([pair, item, doc, at - off]), axis=1)
        pair, item, doc, start = wins
        d = self.edits[item]
        low = np.clip(start - d, 0, len(words))
        high = np.clip(start + self.size[item] + d, 0, len(words))
        n = np.searchsorted(places, pair * stride + high) - np.searchsorted(places, pair * stride + low)
        pair, item, doc, start = wins[:, n >= self.need[item]]
        if not len(pair):
            return {}
        # neighbouring windows of a text and item are verified together, once one of them collides
        new = np.ones(len(pair), dtype=bool)
        new[1:] = (pair[1:] != pair[:-1]) | (start[1:] - start[:-1] > self.size[item[1:]])
        group = np.cumsum(new) - 1
        hit = np.zeros(group[-1] + 1, dtype=bool)
        for size in np.unique(self.size[item]):
            mine = np.flatnonzero(self.size[item] == size)
            for k in range(0, len(mine), 4096):
                self._collide(words, docs, mine[k:k + 4096], item, doc, start, int(size), group, hit)
        best: dict = {}
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(pair)) - 1
        for g in np.flatnonzero(hit):
            i, t = int(item[first[g]]), int(doc[first[g]])
            size, d, lo, hi = int(self.size[i]), int(self.edits[i]), int(docs[t]), int(docs[t + 1])
            a, b = max(lo, int(start[first[g]]) - d), min(hi, int(start[last[g]]) + size + d)
            edits, end = edit_distance_within(self.items[i][1], words[a:b])
            if edits <= d:
                place = (edits, max(0, a + end - size - lo), size)
                best[t, i] = min(best.get((t, i), place), place)
        return best

    def _collide(self, words, docs, mine, item, doc, start, size, group, hit):
        """Mark the groups of which a window has an LSH key of its item."""
        import numpy as np
        lo, hi = docs[doc[mine]], docs[doc[mine] + 1]
        where = start[mine][:, None] + np.arange(size)
        inside = (where >= lo[:, None]) & (where < hi[:, None])
        rows = np.where(inside, words[np.clip(where, 0, len(words) - 1)], np.uint64(0))
        if self.keys[size] is None:
            hit[group[mine]] = True
            return
        for walk, table in enumerate(self.keys[size]):
            live = np.flatnonzero(~hit[group[mine]])
            if not len(live):
                break
            for i, k in zip(mine[live].tolist(), cgk_keys(rows[live], walk).tolist()):
                if int(item[i]) in table.get(k, ()):
                    hit[group[i]] = True


def _held(block: Block, texts):
    """Yield ``(row, item, place)`` for the texts of an Arrow column, some words at a time."""
    import numpy as np
    part, size = [], 0
    for row, t in enumerate(texts):
        if t.is_valid:
            w = word_hashes(np.frombuffer(t.as_buffer(), dtype=np.uint8))
            if len(w):
                part.append((row, w))
                size += len(w)
        if part and (size >= 1 << 18 or row == len(texts) - 1):
            docs = np.cumsum([0] + [len(w) for _, w in part])
            for (d, i), place in block.matches(np.concatenate([w for _, w in part]), docs).items():
                yield part[d][0], i, place
            part, size = [], 0


def _find_kernel(shared):
    def run(batches):
        import pyarrow as pa
        block = shared.value
        for b in batches:
            ids = b.column(0).to_pylist()
            found = [(ids[row], block.items[i][0], *place) for row, i, place in _held(block, b.column(1))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)],
                                                 names=["doc_id", "item_id", "n_edits", "first_word", "item_words"])
    return run


def _keep_kernel(shared, at: int):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            keep = [True] * b.num_rows
            for row, _, _ in _held(shared.value, b.column(at)):
                keep[row] = False
            yield b.filter(pa.array(keep, pa.bool_()))
    return run


def _build(similarity: float, recall: float):
    def build(key, rows):
        import pickle
        import numpy as np
        import pyarrow as pa
        own = sorted(zip(rows.column("item_id").to_pylist(), rows.column("text").to_pylist()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        block = Block([(i, word_hashes(np.frombuffer(t.encode("utf-8"), dtype=np.uint8))) for i, t in own], similarity, recall)
        return pa.table({"block": pa.array([pickle.dumps(block)] if block.items else [], pa.binary())})
    return build


def _blocks(items: DataFrame, item_col: str, item_text_col: str, similarity: float, recall: float):
    """Yield broadcast blocks of the items, of about ``BLOCK_CHARS`` bytes each; a task builds each of them."""
    import pickle
    spark = items.sparkSession
    query = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where("text is not null")
    chars = query.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-int(chars) // BLOCK_CHARS)
    if n:
        built = query.distinct().groupBy(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).alias("_block")) \
            .applyInArrow(_build(similarity, recall), "block binary")
        for row in built.toLocalIterator():  # one at a time passes the driver
            yield spark.sparkContext.broadcast(pickle.loads(row["block"]))


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", similarity: float = 0.8, recall: float = 0.99) -> DataFrame:
    """``(doc_id, item_id, n_edits, first_word, item_words)``: each item that a text holds, at its best place.

    An item of L words is held if some run of the text's words is within ``(1 - similarity) * L`` word edits.
    Whole texts are read; of equally good places the first is returned.  Null, empty and word-less texts and items
    match nothing; items of fewer than five words match exactly.  Repeated rows and items each give their rows; a null
    id stays null; no documents or no items give no rows; extra columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, n_edits long, first_word long, item_words long"
    out = spark.createDataFrame([], schema)
    for block in _blocks(items, item_col, item_text_col, similarity, recall):
        out = out.unionByName(src.mapInArrow(_find_kernel(block), schema))
    return out


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               similarity: float = 0.8, recall: float = 0.99) -> DataFrame:
    """The input rows whose text holds no item, all columns unchanged: rows are judged where they are read."""
    prepare(docs.sparkSession)
    out = docs
    for block in _blocks(items, item_col, item_text_col, similarity, recall):
        out = out.mapInArrow(_keep_kernel(block, docs.columns.index(text_col)), docs.schema)
    return out
