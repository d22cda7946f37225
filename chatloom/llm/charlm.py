"""Character n-gram models in sorted hash arrays, for several labels at once.

One table per order holds every n-gram that any label has seen, sorted by a 64-bit hash, with the exact
smoothed log-probability under each label; a second one holds the contexts' back-off weights.  An n-gram
that is in the table needs one look-up for all labels; only the others back off.
Smoothing is interpolated Kneser-Ney ("kn") or Witten-Bell ("wb").
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAD = 0x20
_PRIME = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
SLICE = 1 << 18  # symbols that are scored at a time


@lru_cache(maxsize=1)
def _mixed():
    """A random 64-bit value for each code point (splitmix64)."""
    import numpy as np
    with np.errstate(over="ignore"):
        z = np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


@lru_cache(maxsize=1)
def _letters():
    """(symbol of each code point, is it a letter): letters and marks lower-cased, all else a blank."""
    import numpy as np
    sym, letter = np.full(0x110000, PAD, dtype=np.uint32), np.zeros(0x110000, dtype=bool)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LM":
            low = chr(cp).lower()
            sym[cp] = ord(low[0])
            letter[cp] = kind == "L"
    return sym, letter


def code_points(text: str):
    import numpy as np
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def letter_symbols(text: str | None):
    """Symbols of the whole text for language models: lower-case letters, runs of all else as one blank.

    Empty if the text is null or has no letter.
    """
    import numpy as np
    cps = code_points(text or "")
    sym, letter = _letters()
    if not letter[cps].any():
        return np.empty(0, dtype=np.uint32)
    s = sym[cps]
    keep = s != PAD
    keep[1:] |= s[:-1] != PAD
    return s[keep]


def normalise_url(host: Column, path: Column) -> Column:
    """What the URL models read: host and path with digits folded."""
    return F.regexp_replace(F.concat(host, path), "[0-9]", "0")


def ngram_hashes(sym, order: int):
    """Hashes of the n-grams ending at each symbol, for n = 1..order; valid from index n - 1 on."""
    import numpy as np
    out = []
    with np.errstate(over="ignore"):
        m = _mixed()[sym]
        h = m
        out.append(h)
        for n in range(2, order + 1):
            nxt = h.copy()
            nxt[n - 1:] += m[:len(m) - n + 1] * np.uint64(pow(_PRIME, n - 1, 1 << 64))
            h = nxt
            out.append(h)
    return out


class HashArray:
    """Sorted 64-bit hashes with an index on their leading bits."""

    def __init__(self, keys):
        import numpy as np
        self.n = len(keys)
        self.shift = 64 - max(1, int(self.n).bit_length() + 1)
        firsts = np.arange(1 << (64 - self.shift), dtype=np.uint64) << np.uint64(self.shift)
        self.first = np.searchsorted(keys, firsts).astype(np.int64)
        self.keys = np.append(keys, np.uint64(_MASK))

    def find(self, h):
        """Position of each hash, or -1."""
        import numpy as np
        pos = self.first[(h >> np.uint64(self.shift)).astype(np.int64)]
        less = np.flatnonzero(self.keys[pos] < h)
        while len(less):
            pos[less] += 1
            less = less[self.keys[pos[less]] < h[less]]
        pos[(self.keys[pos] != h) | (pos >= self.n)] = -1
        return pos


class CharModel:
    """Smoothed n-gram models of several labels; see the module's text."""

    def __init__(self, labels, order, grams, contexts, base):
        self.labels, self.order, self.grams, self.contexts, self.base = labels, order, grams, contexts, base

    @staticmethod
    def build(counts: dict[str, dict[str, int]], order: int, smoothing: str) -> "CharModel":
        """``counts``: per label, occurrences of each n-gram of the highest order."""
        import numpy as np
        labels = sorted(counts)
        level = {lab: dict(counts[lab]) for lab in labels}
        levels = {order: level}
        for n in range(order - 1, 0, -1):
            nxt = {}
            for lab in labels:
                c: Counter = Counter()
                for g, k in level[lab].items():
                    c[g[1:]] += 1 if smoothing == "kn" else k
                nxt[lab] = c
            levels[n] = level = nxt
        symbols = {g for lab in labels for g in levels[1][lab]}
        base = 1.0 / (len(symbols) + 1)  # one share for all unseen symbols
        lower, grams, contexts = None, {}, {}
        for n in range(1, order + 1):
            names = sorted({g for lab in labels for g in levels[n][lab]})
            p = np.empty((len(names), len(labels)))
            lam: dict[str, list[float]] = defaultdict(lambda: [1.0] * len(labels))
            low = np.array([lower[g[1:]] for g in names]) if n > 1 else np.full((len(names), len(labels)), base)
            for j, lab in enumerate(labels):
                c = levels[n][lab]
                total, types = Counter(), Counter()
                for g, k in c.items():
                    total[g[:-1]] += k
                    types[g[:-1]] += 1
                ones, twos = sum(k == 1 for k in c.values()), sum(k == 2 for k in c.values())
                d = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
                for h, t in total.items():
                    lam[h][j] = d * types[h] / t if smoothing == "kn" else types[h] / (t + types[h])
                for i, g in enumerate(names):
                    k, t = c.get(g, 0), total.get(g[:-1], 0)
                    own = 0.0 if not t else max(k - d, 0) / t if smoothing == "kn" else k / (t + types[g[:-1]])
                    p[i, j] = own + (lam[g[:-1]][j] if t else 1.0) * low[i, j]
            lower = dict(zip(names, p))
            grams[n] = _table(names, np.log(p) if len(names) else p, n)
            heads = sorted(lam)
            contexts[n] = _table(heads, np.log(np.array([lam[h] for h in heads])), n - 1) if n > 1 else \
                np.log(np.array(lam.get("", [1.0] * len(labels))))
        return CharModel(labels, order, grams, contexts, float(np.log(base)))

    def _log_probs(self, hashes, at, n):
        """Log-probabilities (positions x labels) of the symbols at ``at`` under order ``n``."""
        import numpy as np
        index, values = self.grams[n]
        pos = index.find(hashes[n - 1][at])
        out = values[pos]
        miss = np.flatnonzero(pos < 0)
        if len(miss):
            where = at[miss]
            if n == 1:
                out[miss] = self.contexts[1] + self.base
            else:
                low = self._log_probs(hashes, where, n - 1)
                heads, weights = self.contexts[n]
                head = heads.find(hashes[n - 2][where - 1])
                low += np.where((head >= 0)[:, None], weights[head], 0)
                out[miss] = low
        return out

    def score(self, docs) -> tuple:
        """(sums of log-probabilities, documents x labels; symbols of each) of symbol arrays, read whole."""
        import numpy as np
        sums, sizes = np.zeros((len(docs), len(self.labels))), np.array([len(d) for d in docs], dtype=np.int64)
        pad = np.full(self.order - 1, PAD, dtype=np.uint32)
        parts, at, owner, length = [], [], [], 0

        def flush():
            nonlocal parts, at, owner, length
            if parts:
                hashes = ngram_hashes(np.concatenate(parts), self.order)
                lp = self._log_probs(hashes, np.concatenate(at), self.order)
                starts = np.cumsum([0] + [len(a) for a in at[:-1]])
                np.add.at(sums, np.array(owner), np.add.reduceat(lp, starts, axis=0, dtype=np.float64))
            parts, at, owner, length = [], [], [], 0

        for i, d in enumerate(docs):
            for k in range(0, len(d), SLICE):
                head = pad if k == 0 else d[k - len(pad):k]
                piece = d[k:k + SLICE]
                parts += [head, piece]
                at.append(np.arange(length + len(head), length + len(head) + len(piece)))
                owner.append(i)
                length += len(head) + len(piece)
                if length >= SLICE:
                    flush()
        flush()
        return sums, sizes


def _table(names, values, n):
    import numpy as np
    if not names:
        return HashArray(np.empty(0, dtype=np.uint64)), np.zeros((1, values.shape[1] if values.ndim > 1 else 1), np.float32)
    sym = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(names), n)
    with np.errstate(over="ignore"):
        h = np.zeros(len(names), dtype=np.uint64)
        for j in range(n):
            h += _mixed()[sym[:, n - 1 - j]] * np.uint64(pow(_PRIME, j, 1 << 64))
    order = np.argsort(h)
    return HashArray(h[order]), values[order].astype(np.float32)


def _count_kernel(order: int, letters: bool):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            labels, texts = b.column(0).to_pylist(), b.column(1)
            groups = defaultdict(list)
            for lab, t in zip(labels, texts):
                t = t.as_py()
                sym = letter_symbols(t) if letters else code_points(t or "")
                if len(sym):
                    groups[lab] += [np.full(order - 1, PAD, dtype=np.uint32), sym]
            out_l, out_g, out_n = [], [], []
            for lab, parts in groups.items():
                sym = np.concatenate(parts)
                ok = np.concatenate([np.full(len(p), k % 2 == 1) for k, p in enumerate(parts)])
                at = np.flatnonzero(ok)
                h, first, n = np.unique(ngram_hashes(sym, order)[-1][at], return_index=True, return_counts=True)
                ends = at[first]
                grams = sym[ends[:, None] + np.arange(1 - order, 1)]
                text = grams.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                out_g += [text[i:i + order] for i in range(0, len(text), order)]
                out_l += [lab] * len(n)
                out_n += n.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(out_l, pa.string()), pa.array(out_g, pa.string()),
                                              pa.array(out_n, pa.int64())], names=["label", "gram", "n"])
    return run


def count_ngrams(rows: DataFrame, order: int, letters: bool = False) -> dict[str, dict[str, int]]:
    """Counts of the highest order per label of ``(label, text)``; for bounded samples only, as they are collected."""
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    got = rows.select("label", "text").mapInArrow(_count_kernel(order, letters), "label string, gram string, n long") \
        .groupBy("label", "gram").agg(F.sum("n").alias("n")).toArrow()
    for lab, g, n in zip(*(got.column(c).to_pylist() for c in ("label", "gram", "n"))):
        counts[lab][g] = n
    return dict(counts)


class MarkovPair:
    """Witten-Bell models of accepted ("true") and rejected ("false") texts and the calibrated threshold."""

    def __init__(self, model: CharModel | None):
        self.model, self.threshold = model, 0.0

    @staticmethod
    def build(counts: dict[str, dict[str, int]], order: int) -> "MarkovPair":
        return MarkovPair(CharModel.build(counts, order, "wb") if {"true", "false"} <= set(counts) else None)

    def scores(self, texts) -> list[float]:
        """Mean log-likelihood difference a symbol, accepted less rejected; 0 for an empty text."""
        import numpy as np
        if self.model is None or not texts:
            return [0.0] * len(texts)
        sums, sizes = self.model.score([code_points(t or "") for t in texts])
        yes, no = self.model.labels.index("true"), self.model.labels.index("false")
        return ((sums[:, yes] - sums[:, no]) / np.maximum(sizes, 1)).tolist()

    def calibrate(self, rows) -> None:
        """``rows``: (accepted, score, count) of held-out texts; the threshold with least balanced error."""
        total = {flag: sum(r["count"] for r in rows if r["accepted"] == flag) for flag in (True, False)}
        if not total[True] or not total[False]:
            return
        # going up, the scores below the threshold are blocked
        cost = best = 1.0  # all rejected texts allowed
        cuts = sorted({r["score"] for r in rows})
        by = defaultdict(lambda: [0, 0])
        for r in rows:
            by[r["score"]][bool(r["accepted"])] += r["count"]
        self.threshold = cuts[0]
        for i, s in enumerate(cuts):
            cost += by[s][1] / total[True] - by[s][0] / total[False]
            if cost < best:
                best = cost
                self.threshold = (s + cuts[i + 1]) / 2 if i + 1 < len(cuts) else s + 0.001
