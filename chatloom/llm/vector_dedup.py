"""Embedding near-duplicates by sorted projection passes.

Each pass has its own random hyperplanes; vectors are ordered by the concatenated sign bits of what is left of them
without their mean, and compared (as they are) with the next ``window`` vectors in that order.  The number of passes
and the window follow from the number of vectors, how they crowd together and a target recall (``plan``).  Verified pairs of all passes are united.  The order's ranks are
distributed (no pass is sorted in one task): only ``(rep, pass, key)`` is range-sorted, then blocks of
consecutive ranks, each with the head of the next one, meet their vectors once.  Equal vectors form a class
first, so copies of a vector are one row in every pass.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import connected_components, cut, prepare
from chatloom.operators.batches import dense_positions

BITS = 60
RECALL = 0.99  # share of the pairs at the threshold that the passes are planned to find, also where vectors crowd most
LEAST = (20, 128)  # passes and window that any table gets
MAX_PASSES = 1024
SAMPLE = 2048  # about so many vectors, drawn by a hash rate, from which the crowding is estimated, of all lengths together
MADE_BYTES = 1 << 26  # hyperplanes that a worker keeps


def planes(dim: int, pass_no: int, seed: int):
    import numpy as np
    return np.random.RandomState((seed * 1009 + pass_no) % (1 << 31)).standard_normal((dim, BITS))


def _unit(v):
    import numpy as np
    v = v / np.abs(v).max(axis=1)[:, None]  # no square overflows or vanishes
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _by_length(vecs):
    """``(length, row numbers, vectors as a matrix)`` for each length in a list column."""
    import numpy as np
    import pyarrow as pa
    sizes = np.diff(vecs.offsets.to_numpy())
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        yield dim, rows, vecs.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)


def _sum_kernel(batches):
    import numpy as np
    import pyarrow as pa
    sums: dict = {}
    for b in batches:
        for dim, rows, v in _by_length(b.column(0)):
            total, n = sums.get(dim, (0.0, 0))
            sums[dim] = total + _unit(v).sum(axis=0), n + len(rows)
    for dim, (total, n) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)), pa.array(total),
             pa.array(np.full(dim, n, np.int64))], names=["dim", "at", "total", "n"])


def means(classes: DataFrame) -> dict:
    """``{length: (mean of the unit vectors, number of vectors)}``; one number per dimension reaches the driver."""
    import numpy as np
    rows = classes.select("vec").mapInArrow(_sum_kernel, "dim int, at int, total double, n long") \
        .groupBy("dim", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    out = {r.dim: (np.zeros(r.dim), r.n) for r in rows}
    for r in rows:
        out[r.dim][0][r["at"]] = r.total / r.n
    return out


def hit_rates(unit, mean, n: int, threshold: float, windows: list[int]):
    """For each window and sampled unit vector the chance that one pass compares it with a vector at the threshold.

    A bit of two vectors agrees with probability 1 - angle / pi, so a vector shares its first l bits with
    n * mean(agree ** l) others; a pair that parts at bit l stands in two halves of such a group.  Vectors that link
    with the sampled one are no crowd to get through and not counted.
    """
    import numpy as np
    v = unit - mean
    size = np.maximum(np.einsum("ij,ij->i", v, v), 1e-12)
    agree = 1 - np.arccos(np.clip(v @ v.T / np.sqrt(size[:, None] * size[None]), -1, 1)) / np.pi
    agree[unit @ unit.T >= threshold] = 0.0
    pair = 1 - np.arccos(np.clip(1 - (1 - threshold) / size, -1, 1)) / np.pi
    hits, power, start = np.zeros((len(windows), len(v))), np.where(agree > 0, 1.0, 0.0), np.ones(len(v))
    for bit in range(BITS + 1):
        crowd = np.maximum(n * power.sum(axis=1) / max(len(v) - 1, 1), 1.0)
        part = start * (1 - pair) if bit < BITS else start
        for i, w in enumerate(windows):
            x = np.minimum(w / crowd, 1.0)
            hits[i] += part * np.where(x <= 0.5, 2 * x * x, 1 - 2 * (1 - x) ** 2)
        power, start = power * agree, start * pair
    return hits


def missed(hits, passes: int) -> float:
    """Share of the pairs missed by that many passes, over the tenth of the vectors that is hardest to find pairs of."""
    import numpy as np
    return float(np.sort((1 - hits) ** passes)[-max(len(hits) // 10, 1):].mean())


def plan(classes: DataFrame, threshold: float, block_size: int, recall: float = RECALL) -> tuple[int, int, dict]:
    """``(passes, window, {length: centre})``: the cheapest passes and window that reach ``recall``.

    The centre is the mean, or nothing where that is cheaper.  If ``MAX_PASSES`` of the widest window (a block) don't
    reach it, those are taken and a warning names the recall to expect.  A crowd that is rarer than one in ``SAMPLE``
    vectors may not be seen.
    """
    import numpy as np
    mean = means(classes)
    # about SAMPLE vectors, drawn where they lie: a task sends its share, not SAMPLE vectors of its own
    share = min(1.0, SAMPLE / max(sum(n for _, n in mean.values()), 1))
    rows = classes.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 31)) < int(share * (1 << 31))).select("vec").collect()
    windows = [w for w in (LEAST[1] << i for i in range(20)) if w <= block_size] or [block_size]
    need, centre = np.full(len(windows), LEAST[0]), {}
    for dim, (mu, n) in mean.items():
        centre[dim] = mu
        unit = [r.vec for r in rows if len(r.vec) == dim]
        if len(unit) < 2 or n <= windows[0]:
            continue
        unit = _unit(np.array(unit, dtype=np.float64))
        best = None
        for c in (mu, np.zeros(dim)):
            hits = hit_rates(unit, c, n, threshold, windows)
            tries = [next((p for p in range(1, MAX_PASSES + 1) if missed(h, p) <= 1 - recall), MAX_PASSES + 1) for h in hits]
            cost = min(t * (w + 512) for t, w in zip(tries, windows))
            if best is None or cost < best[0]:
                best, centre[dim] = (cost, tries, hits), c
        if min(best[1]) > MAX_PASSES:
            found = 1 - missed(best[2][-1], MAX_PASSES)
            warnings.warn(f"vectors of length {dim}: about {found:.3f} of the pairs at the threshold are found, not {recall}", stacklevel=2)
        need = np.maximum(need, best[1])
    # a pass costs its shuffle, worth about 512 comparisons, and its window
    i = min(range(len(windows)), key=lambda i: (need[i] > MAX_PASSES, need[i] * (windows[i] + 512) if need[i] <= MAX_PASSES else -windows[i]))
    return int(min(need[i], MAX_PASSES)), windows[i], centre


def _key_kernel(passes: int, seed: int, centre: dict):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        made: dict = {}
        weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        for b in batches:
            reps = b.column(0).to_numpy()
            for dim, rows, v in _by_length(b.column(1)):
                v = _unit(v) - centre[dim]
                for p in range(passes):
                    h = made.get((dim, p))
                    if h is None:
                        h = planes(dim, p, seed)
                        if sum(x.nbytes for x in made.values()) < MADE_BYTES:
                            made[dim, p] = h
                    key = ((v @ h) > 0) @ weights
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reps[rows]), pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, p, np.int32)),
                         pa.array(key)], names=["rep", "dim", "pass", "key"])
    return run


def _block_kernel(window: int, block_size: int, threshold: float):
    def run(key, table):
        import numpy as np
        import pyarrow as pa
        table = table.combine_chunks().sort_by("pos")
        block = key[2].as_py()
        pos, rep = table["pos"].to_numpy(), table["rep"].to_numpy()
        col = table["vec"].combine_chunks()
        v = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(pos), -1)
        norm = np.sqrt(np.einsum("ij,ij->i", v, v))
        out_a, out_b = [], []
        own = int(np.searchsorted(pos, (block + 1) * block_size))  # the rest is the head of the next block
        for i in range(0, own, 256):
            j = min(i + 256, own)
            to = min(j + window, len(pos))
            cos = v[i:j] @ v[i:to].T / (norm[i:j, None] * norm[None, i:to])
            x, y = np.nonzero(cos >= threshold)
            ok = (y > x) & (y - x <= window)
            out_a.append(rep[x[ok] + i])
            out_b.append(rep[y[ok] + i])
        a = np.concatenate(out_a) if out_a else np.empty(0, np.int64)
        b = np.concatenate(out_b) if out_b else np.empty(0, np.int64)
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})
    return run


def usable(vector):
    """Not null, no null or non-finite component, not zero."""
    inf = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def find_links(classes: DataFrame, threshold: float = 0.95, passes: int | None = None, window: int | None = None, seed: int = 11,
               block_size: int = 4096) -> DataFrame:
    """Distinct ``(a, b)`` pairs (a < b) of ``(rep, vec)`` rows that some pass finds and whose cosine is enough."""
    spark = classes.sparkSession
    prepare(spark)
    planned_passes, planned_window, centre = plan(classes, threshold, block_size)
    passes, window = passes or planned_passes, window or planned_window
    keys = classes.select("rep", "vec").mapInArrow(_key_kernel(passes, seed, centre), "rep long, dim int, pass int, key long")
    ranked = dense_positions(keys, ["dim", "pass"], ["key", "rep"])
    at = F.floor(F.col("pos") / block_size).cast("long")
    heads = F.when((F.col("pos") % block_size < window) & (F.col("pos") >= block_size), F.array(at, at - 1)).otherwise(F.array(at))
    placed = ranked.select("rep", "dim", "pass", "pos", F.explode(heads).alias("block"))
    met = placed.join(classes.select("rep", "vec"), "rep")
    return met.groupBy("dim", "pass", "block").applyInArrow(_block_kernel(window, block_size, threshold), "a long, b long").distinct()


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                    passes: int | None = None, window: int | None = None, seed: int = 11, block_size: int = 4096) -> DataFrame:
    """One row per input row: ``(vec_id, n_links, component_id, kept)``.

    ``n_links``: other rows that are linked directly (cosine of the whole vectors in double precision at least
    ``threshold``, copies included); ``component_id``: the smallest id reachable by links, itself included.
    ``passes`` and ``window`` are planned for ``RECALL`` of the pairs at the threshold unless given.
    Links that no pass brings within the window are missed; none below the threshold is made.  Vectors that are
    null, empty, zero or hold a null or non-finite component link with nothing, and vectors of different lengths
    don't link.  Rows without an id don't link either (component null, not kept).  Rows that repeat an id and
    vector count as copies.  Extra columns are not read; an empty table gives no rows.
    """
    prepare(vectors.sparkSession)
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    good = src.where(usable(F.col("vec")) & F.col("vec_id").isNotNull())
    classes = cut(good.groupBy("vec").agg(F.min("vec_id").alias("rep0"), F.count(F.lit(1)).alias("size"))
                  .select(F.col("rep0").alias("rep"), "vec", "size"))
    links = cut(find_links(classes.select("rep", "vec"), threshold, passes, window, seed, block_size))
    both = links.union(links.select("b", "a"))
    others = both.join(classes.select(F.col("rep").alias("b"), "size"), "b") \
        .groupBy(F.col("a").alias("rep")).agg(F.sum("size").alias("others"))
    comps = connected_components(links).select(F.col("node").alias("rep"), "component")
    facts = classes.join(others, "rep", "left").join(comps, "rep", "left").select(
        F.col("vec").alias("cvec"), (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    member = (F.col("vec") == F.col("cvec")) & F.col("vec_id").isNotNull()
    return src.join(facts, member, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"))
