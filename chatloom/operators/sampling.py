"""H1–H7: candidate truncation and sampling.

Over a ``logits(ctx_id, token_id, logit)`` table every step is a projection or a window partitioned by ``ctx_id`` (a
context has at most vocabulary-size rows), so any number of contexts scales out.  Order of the steps: temperature →
repetition penalty → top-k → nucleus → softmax → draw.

Where logits depend on the last token alone (a bigram model), ``sample_windows`` makes *every* position of every window
a context without a row per context and token: one candidate table per last token, corrected per context for its few
recent tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.kernels import row_slices
from chatloom.schema import DEFAULT_REPETITION_PENALTY, DEFAULT_TEMPERATURE, DEFAULT_TOP_K, DEFAULT_TOP_P

RECENT_WINDOW = 10   # generated tokens considered by the repetition penalty


def apply_temperature(logits: DataFrame, temperature: float = DEFAULT_TEMPERATURE) -> DataFrame:
    """H1: logit / T."""
    return logits.withColumn("logit", F.col("logit") / F.lit(temperature))


def recent_sets(recent: DataFrame, last_n: int = RECENT_WINDOW) -> DataFrame:
    """(ctx_id, recent_ids): distinct tokens among the last ``last_n`` generated, one row per context.

    ``pos`` orders the generated tokens and may have gaps.  A bounded top-n aggregate per context: each task
    keeps ``last_n`` rows of a context, so a long history is neither one task nor sorted.
    """
    head = Window.partitionBy("ctx_id").orderBy(F.col("pos").desc())
    return recent.withColumn("_rk", F.row_number().over(head)).where(F.col("_rk") <= last_n) \
        .groupBy("ctx_id").agg(F.collect_set("token_id").alias("recent_ids"))


def repetition_penalty(logits: DataFrame, recent: DataFrame, penalty: float = DEFAULT_REPETITION_PENALTY,
                       last_n: int = RECENT_WINDOW) -> DataFrame:
    """H2: divide the logit of each distinct token among the last ``last_n`` generated (raw divide).

    ``recent`` is ``(ctx_id, pos, token_id)``; it is reduced to one small array per
    context and joined on ``ctx_id`` alone, so every later window (all partitioned
    by ``ctx_id``) reuses this join's partitioning.
    """
    if penalty <= 1.0:
        return logits
    sets = recent_sets(recent, last_n)
    out = logits.join(sets, "ctx_id", "left")
    hit = F.coalesce(F.array_contains("recent_ids", F.col("token_id")), F.lit(False))
    return out.withColumn("logit", F.when(hit, F.col("logit") / F.lit(penalty)).otherwise(F.col("logit"))) \
        .drop("recent_ids")


def top_k_filter(logits: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """H3: keep logits ≥ the k-th largest of the context (ties kept)."""
    if k <= 0:
        return logits
    w = Window.partitionBy("ctx_id").orderBy(F.col("logit").desc())
    return logits.withColumn("_rk", F.rank().over(w)).where(F.col("_rk") <= k).drop("_rk")


def _desc(c: str = "logit") -> Window:
    return Window.partitionBy("ctx_id").orderBy(F.col(c).desc(), F.col("token_id"))


def softmax(logits: DataFrame, out_col: str = "prob") -> DataFrame:
    """H5: max-shifted exp / sum per context."""
    wc = Window.partitionBy("ctx_id")
    e = F.exp(F.col("logit") - F.max("logit").over(wc))
    return logits.withColumn("_e", e).withColumn(out_col, F.col("_e") / F.sum("_e").over(wc)).drop("_e")


def nucleus_filter(logits: DataFrame, p: float = DEFAULT_TOP_P) -> DataFrame:
    """H4: descending by logit, keep a token iff the probability mass before it is ≤ p (first always kept)."""
    if p >= 1.0:
        return logits
    s = softmax(logits, "_p")
    before = F.coalesce(F.sum("_p").over(_desc().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return s.withColumn("_before", before).where(F.col("_before") <= F.lit(p)).drop("_p", "_before")


def draw_uniform(seed: int, ctx: Column) -> Column:
    """u in [0, 1) from md5(seed:ctx) — the same number in any SQL engine."""
    h = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), ctx.cast("string"))), 1, 8)
    return F.conv(h, 16, 10).cast("double") / F.lit(4294967296.0)


def draw_token(probs: DataFrame, seed: int = 0) -> DataFrame:
    """H6: one multinomial draw per context by inverse CDF over (prob desc, token_id).

    One ordered window: the row whose cumulative interval (prev, cum] holds u; the
    last row also takes u beyond a total that rounding left slightly below 1.
    """
    w = _desc("prob")
    cum = F.sum("prob").over(w.rowsBetween(Window.unboundedPreceding, 0))
    s = probs.withColumn("_cum", cum) \
        .withColumn("_prev", F.coalesce(F.lag("_cum").over(w), F.lit(0.0))) \
        .withColumn("_last", F.lead("token_id").over(w).isNull()) \
        .withColumn("_u", draw_uniform(seed, F.col("ctx_id")))
    pick = (F.col("_prev") <= F.col("_u")) & ((F.col("_cum") > F.col("_u")) | F.col("_last"))
    return s.where(pick).select("ctx_id", "token_id")


def sample_next(logits: DataFrame, recent: DataFrame, temperature: float = DEFAULT_TEMPERATURE,
                penalty: float = DEFAULT_REPETITION_PENALTY, k: int = DEFAULT_TOP_K, p: float = DEFAULT_TOP_P,
                seed: int = 0) -> DataFrame:
    """H1→H6 in the reference order."""
    x = apply_temperature(logits, temperature)
    x = repetition_penalty(x, recent, penalty)
    x = top_k_filter(x, k)
    x = nucleus_filter(x, p)
    return draw_token(softmax(x), seed)


def cross_entropy(logits: DataFrame, targets: DataFrame) -> DataFrame:
    """H7: −log softmax at the target token = logsumexp − logit[target] per context (NULL without that logit).

    The target rides along the logits: one shuffle on ``ctx_id`` serves the maximum and the sum.
    """
    j = targets.withColumnRenamed("token_id", "_target").join(logits, "ctx_id", "left") \
        .withColumn("_m", F.max("logit").over(Window.partitionBy("ctx_id")))
    lse = F.first("_m") + F.log(F.sum(F.exp(F.col("logit") - F.col("_m"))))
    at = F.max(F.when(F.col("token_id") == F.col("_target"), F.col("logit")))
    return j.groupBy("ctx_id", F.col("_target").alias("token_id")).agg((lse - at).alias("ce"))


# -- every position of the windows, factorised by the last token --------------------------------------------------
MAX_CANDIDATES = 4_000_000   # rows (16 bytes each) of a candidate table that is broadcast


def candidate_table(logits: DataFrame, temperature: float = DEFAULT_TEMPERATURE, k: int = DEFAULT_TOP_K,
                    last_n: int = RECENT_WINDOW) -> DataFrame:
    """H1 per last token: ``(prev_id, token_id, logit)``, the logits / T that can reach a context's top ``k``.

    ``logits``: ``(prev_id, token_id, logit)``.  A penalty lowers at most ``last_n`` positive logits, so the first
    ``k + last_n`` with ties suffice.  Negative logits rise when divided, so they are all kept, as are all where k is 0.
    """
    scaled = logits.select("prev_id", "token_id", (F.col("logit") / F.lit(temperature)).alias("logit"))
    if k <= 0:
        return scaled
    rank = F.rank().over(Window.partitionBy("prev_id").orderBy(F.col("logit").desc()))
    return scaled.withColumn("_rk", rank).where((F.col("_rk") <= k + last_n) | (F.col("logit") < 0)).drop("_rk")


def _uniforms(seed: int, name: str, n: int):
    """``draw_uniform`` of the contexts ``name:0`` ... ``name:n-1``."""
    from hashlib import md5

    import numpy as np
    head = f"{seed}:{name}:".encode("utf-8")
    return np.frombuffer(b"".join([md5(b"%s%d" % (head, i)).digest()[:4] for i in range(n)]), dtype=">u4") / 4294967296.0


def candidate_arrays(prev, token, logit):
    """``(last tokens, where each one's candidates start, tokens, logits)``: candidates from the highest logit, ties by token."""
    import numpy as np
    order = np.lexsort((token, -logit, prev))
    prevs, starts = np.unique(prev[order], return_index=True)
    return prevs.astype(np.int64), np.append(starts, len(order)), token[order].astype(np.int64), logit[order].astype(np.float64)


def _descending(low, tokens):
    """Order of each row of ``low`` from the highest, equal ones by token.

    The candidates come ordered before the penalty, so few are out of place; only a row where the penalty makes
    different logits equal has to look at the tokens.
    """
    import numpy as np
    order = np.argsort(-low, axis=1, kind="stable")
    ids, ranked = tokens[order], np.take_along_axis(low, order, axis=1)
    tied = np.flatnonzero(((ranked[:, 1:] == ranked[:, :-1]) & (ids[:, 1:] < ids[:, :-1])).any(axis=1))
    for i in tied.tolist():
        order[i] = np.lexsort((tokens, -low[i]))
    if len(tied):
        ids[tied], ranked[tied] = tokens[order[tied]], np.take_along_axis(low[tied], order[tied], axis=1)
    return ids, ranked


def sample_contexts(tokens, logits, recent, target, u, penalty: float, k: int, p: float, figures=None) -> dict:
    """H2–H6 of contexts that share their last token: figures per context, up to the last step that ``figures`` (all) need.

    ``tokens`` and ``logits`` are the last token's candidates as ``candidate_arrays`` orders them; ``recent``: (n, r) token
    ids, repeats allowed.  ``u`` may be None unless tokens are drawn.
    """
    import numpy as np
    want = set(FIGURES if figures is None else figures)
    n, m = len(recent), len(tokens)
    by = np.argsort(tokens)
    at = by[np.minimum(np.searchsorted(tokens, recent, sorter=by), m - 1)]
    row, col = np.nonzero(tokens[at] == recent)
    at = at[row, col]
    hit = np.zeros((n, m), dtype=bool)
    low = np.broadcast_to(logits, (n, m)).copy()
    if penalty > 1:
        hit[row, at] = True
        low[row, at] = (logits / penalty)[at]
    out = {"hits": np.count_nonzero(hit, axis=1), "cut": hit @ (logits - logits / penalty)}
    if not want - out.keys():
        return out
    ids, low = _descending(low, tokens)
    top = low >= low[:, k - 1:k] if 0 < k < m else np.ones((n, m), dtype=bool)
    out |= {"top_kept": np.count_nonzero(top, axis=1), "top_sum": np.where(top, low, 0.0).sum(axis=1)}
    if not want - out.keys():
        return out
    e = np.exp(low - low[:, :1])
    e *= top
    kept = top
    if p < 1:
        mass = e / e.sum(axis=1, keepdims=True)
        np.cumsum(mass, axis=1, out=mass)
        kept[:, 1:] &= mass[:, :-1] <= p
    nucleus = np.count_nonzero(kept, axis=1)
    out |= {"nucleus_kept": nucleus, "nucleus_sum": np.where(kept, low, 0.0).sum(axis=1)}
    if not want - out.keys():
        return out
    e *= kept
    total = e.sum(axis=1)
    out |= {"target_prob": np.where(ids == target[:, None], e, 0.0).sum(axis=1) / total, "best_prob": e[:, 0] / total}
    if "drawn" in want:
        e /= total[:, None]
        above = np.cumsum(e, axis=1, out=e) > u[:, None]
        # the kept are the first of the order; the last of them also takes a draw beyond a total just below 1
        pick = np.where(above[:, -1], above.argmax(axis=1), m)
        out["drawn"] = ids[np.arange(n), np.minimum(pick, nucleus - 1)]
    return out


COUNTS = ("hits", "top_kept", "nucleus_kept")
SUMS = ("cut", "top_sum", "nucleus_sum", "target_prob", "best_prob")
FIGURES = (*COUNTS, *SUMS, "drawn")
CELLS = 1 << 18   # contexts x candidates looked at together
CONTEXTS = 1 << 16   # contexts of the windows looked at together


def _sample_kernel(table, n_keep: int, penalty: float, k: int, p: float, last_n: int, seed: int, figures=FIGURES):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        prevs, starts, tokens, logits = table.value
        numbers = [c for c in figures if c != "drawn"]
        for b in batches:
            for part in row_slices(b, n_keep, CONTEXTS):
                inp, tgt = part.column(n_keep), part.column(n_keep + 1)
                ends = inp.offsets.to_numpy()
                size = np.diff(ends)
                ids = inp.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]].astype(np.int64)
                t = tgt.offsets.to_numpy()
                target = tgt.values.to_numpy(zero_copy_only=False)[t[0]:t[-1]].astype(np.int64)
                first = np.repeat(ends[:-1] - ends[0], size)
                pos = np.arange(len(ids)) - first
                u = None
                if "drawn" in figures:
                    names = [":".join(str(v.as_py()) for v in row) for row in zip(*(part.column(i) for i in range(n_keep)))]
                    u = np.concatenate([_uniforms(seed, name, n) for name, n in zip(names, size.tolist())] or [np.empty(0)])
                got = {c: np.zeros(len(ids), dtype=np.float64 if c in SUMS else np.int64) for c in figures}
                if "drawn" in figures:
                    got["drawn"][:] = -1
                by = np.argsort(ids, kind="stable")
                for group in np.split(by, np.flatnonzero(np.diff(ids[by])) + 1):
                    if not len(group):
                        continue
                    no = np.searchsorted(prevs, ids[group[0]])
                    if no == len(prevs) or prevs[no] != ids[group[0]]:
                        continue  # a last token without candidates: nothing to draw
                    mine = slice(starts[no], starts[no + 1])
                    step = max(1, CELLS // max(1, starts[no + 1] - starts[no]))
                    for a in range(0, len(group), step):
                        g = group[a:a + step]
                        recent = np.stack([np.where(pos[g] >= i, ids[np.maximum(g - i, 0)], -1) for i in range(last_n)], axis=1) \
                            if last_n else np.empty((len(g), 0), dtype=np.int64)
                        v = sample_contexts(tokens[mine], logits[mine], recent, target[g], None if u is None else u[g], penalty, k, p, figures)
                        for c in figures:
                            got[c][g] = v[c]
                cuts = np.concatenate([[0], np.cumsum(size)])
                total = lambda v: np.concatenate([[0], np.cumsum(v)])[cuts[1:]] - np.concatenate([[0], np.cumsum(v)])[cuts[:-1]]
                cols = [pa.array(total(got[c])) if c in COUNTS else
                        pa.array([got[c][x:y].sum() for x, y in zip(cuts[:-1], cuts[1:])], pa.float64()) for c in numbers]
                if "drawn" in figures:
                    cols.append(pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(got["drawn"], pa.int32(), mask=got["drawn"] < 0)))
                yield pa.RecordBatch.from_arrays([*part.columns[:n_keep], *cols],
                                                 names=[*b.schema.names[:n_keep], *numbers, *(["drawn"] if "drawn" in figures else [])])
    return run


def sample_windows(windows: DataFrame, logits: DataFrame, temperature: float = DEFAULT_TEMPERATURE,
                   penalty: float = DEFAULT_REPETITION_PENALTY, k: int = DEFAULT_TOP_K, p: float = DEFAULT_TOP_P, seed: int = 0,
                   last_n: int = RECENT_WINDOW, keep=("sample_id", "window_no"), figures=FIGURES) -> DataFrame:
    """H1–H6 at every position of every window: ``(*keep, hits, top_kept, nucleus_kept, ..., drawn)``, one row a window.

    ``figures`` names the columns to give, in the order of ``FIGURES``; the steps run up to the last one that they need.

    A context is a position: its last token is the input there, its recent tokens the last ``last_n`` inputs of the
    window.  ``logits``: ``(prev_id, token_id, logit)`` by last token.  Sums over the window's contexts: ``hits`` and ``cut``
    (candidates that the penalty touched, and by how much), ``top_kept``/``top_sum`` and ``nucleus_kept``/``nucleus_sum``
    (tokens that stay, and their logits), ``target_prob``, ``best_prob``; ``drawn``: the token drawn at each position, null
    where the last token has no candidates.  The candidate table is broadcast up to ``MAX_CANDIDATES`` rows.
    """
    from chatloom.plans.runtime import ensure_package
    spark = windows.sparkSession
    ensure_package(spark)
    table = candidate_table(logits, temperature, k, last_n).limit(MAX_CANDIDATES + 1).toArrow()
    if table.num_rows > MAX_CANDIDATES:
        raise ValueError(f"over {MAX_CANDIDATES} candidates: lower k, or use the steps over a logits table")
    prev, token, logit = (table.column(c).to_numpy() for c in ("prev_id", "token_id", "logit"))
    shared = spark.sparkContext.broadcast(candidate_arrays(prev, token, logit))
    figures = tuple(c for c in FIGURES if c in figures)
    kinds = {c: "long" for c in COUNTS} | {c: "double" for c in SUMS} | {"drawn": "array<int>"}
    src = windows.select(*keep, "input_ids", "target_ids")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields[:len(keep)])
    return src.mapInArrow(_sample_kernel(shared, len(keep), penalty, k, p, last_n, seed, figures),
                          kept + "".join(f", {c} {kinds[c]}" for c in figures))
