"""Windows of seq_len+1 tokens, next-token pairs and assistant-only loss masks.

Two plans:

* ``cut_windows`` / ``window_spans`` / ``next_token_pairs`` work on token arrays
  with built-in higher-order functions (JVM side, no Python).
* ``build_windows`` (F7, the flagship chain) fuses encode → pad/slide → pairs →
  mask in one ``mapInArrow`` stage: one pass over the text, vocabulary broadcast,
  bounded output batches (a 1 M-token text yields its windows in slices).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.kernels import WindowBuilder, iter_sample_chunks, sample_slices
from chatloom.operators.tokenize import _lookup
from chatloom.plans.runtime import broadcast_value, ensure_package
from chatloom.schema import ASSISTANT_ID, DEFAULT_SEQ_LEN, EOS_ID, PAD_ID, USER_ID, WINDOWS

_PYARROW_WINDOWS = None
# hot-dialog id lists up to this many rows are broadcast to select their turns map-side
HOT_BROADCAST_ROWS = 1_000_000


def _arrow_schema():
    global _PYARROW_WINDOWS
    if _PYARROW_WINDOWS is None:
        import pyarrow as pa
        _PYARROW_WINDOWS = pa.schema([
            ("sample_id", pa.string()), ("window_no", pa.int32()), ("input_ids", pa.list_(pa.int32())),
            ("target_ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.int8())),
        ])
    return _PYARROW_WINDOWS


def append_eos(ids) -> Column:
    """texts end with ``<eos>``."""
    return F.concat(F.col(ids) if isinstance(ids, str) else ids, F.array(F.lit(EOS_ID)))


def _starts(n, seq_len: int, stride: int, keep_tail: bool) -> Column:
    full = F.sequence(F.lit(0), F.greatest(n - seq_len - 1, F.lit(0)), F.lit(stride))
    if keep_tail:
        last = F.try_element_at(full, F.lit(-1))
        full = F.when(last + seq_len + 1 < n, F.concat(full, F.array(n - seq_len - 1))).otherwise(full)
    return F.when(n <= seq_len + 1, F.array(F.lit(0))).otherwise(full)


def window_count(n_tokens: Column, seq_len: int = DEFAULT_SEQ_LEN, stride: int | None = None) -> Column:
    """Number of windows of a sequence of ``n_tokens`` tokens (no tail window)."""
    stride = stride or seq_len // 2
    return F.when(n_tokens <= seq_len + 1, F.lit(1)).otherwise(F.ceil((n_tokens - seq_len) / F.lit(stride))).cast("long")


def window_numbers(lengths: DataFrame, seq_len: int = DEFAULT_SEQ_LEN, stride: int | None = None) -> DataFrame:
    """F3's numbers and starts from ``(sample_id, n_tokens)``: no token is read."""
    stride = stride or seq_len // 2
    n = window_count(F.col("n_tokens"), seq_len, stride)
    return lengths.select("sample_id", F.col("n_tokens").cast("long").alias("n_tokens"),
                          F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("window_no")) \
        .withColumn("start", F.col("window_no").cast("long") * stride)


def window_spans(tokens: DataFrame, seq_len: int = DEFAULT_SEQ_LEN, stride: int | None = None,
                 keep_tail: bool = False, ids_col: str = "token_ids") -> DataFrame:
    """F3 positions: (sample_id, n_tokens, window_no, start, n_pad).

    Windows start at 0, stride, … while start < L − S; count ceil((L−S)/stride);
    samples with L ≤ S+1 give one window padded with L−S−1… pads (F2).
    """
    stride = stride or seq_len // 2
    n = F.size(ids_col)
    return tokens.select("sample_id", n.cast("long").alias("n_tokens"),
                         F.posexplode(_starts(n, seq_len, stride, keep_tail)).alias("window_no", "start")) \
        .select("sample_id", "n_tokens", "window_no", F.col("start").cast("long").alias("start"),
                F.greatest(F.lit(0), seq_len + 1 - F.col("n_tokens")).cast("long").alias("n_pad"))


def cut_windows(tokens: DataFrame, seq_len: int = DEFAULT_SEQ_LEN, stride: int | None = None,
                keep_tail: bool = False, ids_col: str = "token_ids", keep=()) -> DataFrame:
    """F2 + F3 with higher-order functions: (sample_id, *keep, window_no, window array<int> of S+1)."""
    stride = stride or seq_len // 2
    tok = F.col(ids_col)
    n = F.size(tok)
    padded = F.when(n < seq_len + 1, F.concat(tok, F.array_repeat(F.lit(PAD_ID), seq_len + 1 - n))).otherwise(tok)
    wins = F.transform(_starts(n, seq_len, stride, keep_tail), lambda s: F.slice(padded, s + 1, seq_len + 1))
    return tokens.select("sample_id", *keep, F.posexplode(wins).alias("window_no", "window"))


def next_token_pairs(windows: DataFrame, window_col: str = "window") -> DataFrame:
    """input = window[:-1], target = window[1:]."""
    w = F.col(window_col)
    n = F.size(w)
    return windows.withColumn("input_ids", F.slice(w, 1, n - 1)).withColumn("target_ids", F.slice(w, 2, n - 1)) \
        .drop(window_col)


def build_windows(samples: DataFrame, vocab, seq_len: int = DEFAULT_SEQ_LEN, stride: int | None = None,
                  keep_tail: bool = False, text_mask: str = "none", mask_scope: str = "window",
                  escape_specials: bool = False) -> DataFrame:
    """samples -> windows(sample_id, window_no, input_ids, target_ids, loss_mask).

    ``stride`` defaults to seq_len div 2 and is honoured.  ``text_mask='none'``
    keeps the reference's all-zero text masks, ``'all'`` supervises every real
    next token of a text.  ``mask_scope='window'`` restarts the assistant state at
    each window (reference), ``'sample'`` carries it over window starts.
    """
    if text_mask not in ("none", "all") or mask_scope not in ("window", "sample"):
        raise ValueError("text_mask in {'none','all'}, mask_scope in {'window','sample'}")
    stride = stride or seq_len // 2
    spark = samples.sparkSession
    ensure_package(spark)
    bc = broadcast_value(spark, _lookup(vocab))
    cols = [c for c in ("sample_id", "kind", "text", "dialog") if c in samples.columns]

    def run(batches):
        lookup = bc.value
        builder = WindowBuilder(seq_len, stride, keep_tail, text_mask, mask_scope, _arrow_schema())
        for b in batches:
            for part in sample_slices(b):
                for sid, kind, chunks in iter_sample_chunks(part, lookup, escape_specials):
                    yield from builder.add_chunks(sid, chunks, kind != "dialog")
        if builder.n:
            yield builder.flush()

    return samples.select(*cols).mapInArrow(run, WINDOWS)


def mask_coverage(windows: DataFrame, by: str = "sample_id") -> DataFrame:
    """supervised share — windows, Σmask and mean mask per group (partial aggregation)."""
    m = F.aggregate("loss_mask", F.lit(0).cast("long"), lambda acc, x: acc + x)
    return windows.groupBy(by).agg(
        F.count("*").alias("n_windows"),
        F.sum(m).cast("long").alias("mask_sum"),
        (F.sum(m) / F.sum(F.size("loss_mask"))).alias("coverage"),
    )


def _kind(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


# -- turn tables: collect-free windows for dialogs of any size ---------------------------------------------------
def _turn_tokens(lookup, role, text, escape_specials: bool):
    import numpy as np
    from chatloom.functions.kernels import ROLE_TOKEN
    t = lookup.encode(text, escape_specials)
    m = ROLE_TOKEN.get(role)
    return t if m is None else np.concatenate([np.array([m], np.int32), t])


def _count_turns_kernel(bc, escape_specials: bool):
    """Numbers of a turn's tokens: how many, whether a control token is among them, and the state after the last one."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            n, last = [], []
            for role, text in zip(b.column(4), b.column(5)):
                t = _turn_tokens(bc.value, role.as_py(), text.as_py(), escape_specials)
                ctl = t[np.isin(t, (ASSISTANT_ID, USER_ID, EOS_ID))]
                n.append(len(t))
                last.append(int(ctl[-1] == ASSISTANT_ID) if len(ctl) else -1)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(n, pa.int64()), pa.array([int(x >= 0) for x in last], pa.int64()),
                                              pa.array(last, pa.int64())], names=["_id", "_at", "_by", "_tie", "n", "_has", "_ls"])
    return run


def _encode_turns_kernel(bc, escape_specials: bool):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        eos_ids = np.array([EOS_ID], np.int32)
        for b in batches:
            offs, vals = [0], []
            for eos, role, text in zip(b.column("_eos").to_pylist(), b.column("_role"), b.column("_text")):
                t = eos_ids if eos else _turn_tokens(bc.value, role.as_py(), text.as_py(), escape_specials)
                vals.append(t)
                offs.append(offs[-1] + len(t))
            flat = np.concatenate(vals) if vals else np.empty(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat, pa.int32()))
            names = ["_id", "_ord", "_eos", "g0", "n", "_c", "_has", "_ls"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), ids], names=[*names, "ids"])
    return run


def placed_turns(turns: DataFrame, dialogs: DataFrame, bc, escape_specials: bool = False) -> DataFrame:
    """Tokens of ``turns(_id, _ord, _role, _text)`` with their place in the dialog, without a dialog row.

    ``(_id, _ord, _eos, g0, n, _c, _has, _ls, ids)``: a row for each turn with tokens and one ``<eos>`` row for each of
    ``dialogs(_id, _last)``.  ``g0`` / ``_c``: tokens and turns with a control token before it.  Only counts go through
    the prefix sums; text is shuffled once, to meet its place, and encoded there, so token arrays are never
    frozen.  Turns of one number are ordered by role and a hash of role and text; equal rows each get their own place.
    """
    low = F.lit(-(1 << 63)).cast("long")
    src = turns.select("_id", F.coalesce("_ord", low).alias("_at"), F.coalesce("_role", F.lit("")).alias("_by"),
                       F.xxhash64("_role", "_text").alias("_tie"), "_role", "_text", "_ord")
    keys = ["_id", "_at", "_by", "_tie"]
    kind = _kind(src, "_id")
    counts = src.select(*keys, "_role", "_text").mapInArrow(
        _count_turns_kernel(bc, escape_specials), f"_id {kind}, _at long, _by string, _tie long, n long, _has long, _ls long")
    rows = counts.where("n > 0").groupBy(*keys, "n", "_has", "_ls").agg(F.count(F.lit(1)).alias("_m")) \
        .withColumn("_eos", F.lit(False))
    eos = dialogs.select("_id", (F.coalesce("_last", low) + 1).alias("_at"), F.lit("").alias("_by"), F.lit(None).cast("long").alias("_tie"),
                         F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("_has"), F.lit(0).cast("long").alias("_ls"),
                         F.lit(1).cast("long").alias("_m"), F.lit(True).alias("_eos"))
    both = rows.unionByName(eos).withColumn("_nm", F.col("n") * F.col("_m")).withColumn("_hm", F.col("_has") * F.col("_m"))
    from chatloom.operators.batches import prefix_sum
    pre = prefix_sum(both, "_id", ["_at", "_by", "_tie"], ["_nm", "_hm"], ["_g", "_h"])
    x = pre.join(src, keys, "left")  # the <eos> rows meet no text
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_at")) - 1
    x = x.select("_id", "_ord", "_eos", "n", "_has", "_ls", "_role", "_text", F.when(F.col("_m") > 1, nth).otherwise(0).cast("long").alias("_k"),
                 "_g", "_h")
    x = x.select("_id", "_ord", "_eos", (F.col("_g") + F.col("_k") * F.col("n")).alias("g0"), "n",
                 (F.col("_h") + F.col("_k") * F.col("_has")).alias("_c"), "_has", "_ls", "_role", "_text")
    return x.mapInArrow(_encode_turns_kernel(bc, escape_specials),
                        f"_id {kind}, _ord long, _eos boolean, g0 long, n long, _c long, _has long, _ls long, ids array<int>")


def _mask_kernel(seq_len: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from chatloom.functions.kernels import loss_mask
        for b in batches:
            n = b.num_rows
            win = b.column(2)
            block = np.asarray(win.values.to_numpy(zero_copy_only=False), dtype=np.int32)
            block = block[win.offsets[0].as_py(): win.offsets[0].as_py() + n * (seq_len + 1)].reshape(n, seq_len + 1)
            init = (np.asarray(b.column(3).to_numpy(zero_copy_only=False), dtype=np.int8)
                    if b.num_columns > 3 else None)
            mask = loss_mask(block[:, :-1], init)
            offsets = pa.array(np.arange(0, (n + 1) * seq_len, seq_len, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1),
                pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(block[:, :-1]).ravel(), pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(block[:, 1:]).ravel(), pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(mask.ravel(), pa.int8())),
            ], names=WINDOWS.names)
    return run


def _init_state_kernel(seq_len: int, stride: int, keep_tail: bool):
    """Per turn: mask state just before every window start that falls inside the turn (O(turn))."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        S = seq_len
        for b in batches:
            cols = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            ids_col = cols["ids"]
            offs = ids_col.offsets.to_numpy()
            vals = np.asarray(ids_col.values.to_numpy(zero_copy_only=False), dtype=np.int32)
            dlg, g0s, ns, Ls, sbs = (cols[c].to_pylist() for c in ("_id", "g0", "n", "L", "_sb"))
            out_id, out_w, out_s = [], [], []
            for r in range(b.num_rows):
                g0, n, L = g0s[r], ns[r], Ls[r]
                W = 1 if L <= S + 1 else -(-(L - S) // stride)
                cand = []
                w_a, w_b = max(1, -(-(g0 + 1) // stride)), min(W - 1, (g0 + n) // stride)
                cand.extend((w, w * stride) for w in range(w_a, w_b + 1))
                if keep_tail and L > S + 1 and (W - 1) * stride + S + 1 < L and g0 + 1 <= L - S - 1 <= g0 + n:
                    cand.append((W, L - S - 1))
                if not cand:
                    continue
                toks = vals[offs[r]:offs[r + 1]]
                ctl = np.full(len(toks), -1, dtype=np.int8)
                ctl[toks == ASSISTANT_ID] = 1
                ctl[(toks == USER_ID) | (toks == EOS_ID)] = 0
                last = np.maximum.accumulate(np.where(ctl >= 0, np.arange(len(toks)), -1))
                for w, start in cand:
                    lp = last[start - g0 - 1]
                    out_id.append(dlg[r])
                    out_w.append(w)
                    out_s.append(int(ctl[lp] == 1) if lp >= 0 else int(sbs[r]))
            yield pa.RecordBatch.from_arrays([pa.array(out_id, cols["_id"].type), pa.array(out_w, pa.int64()),
                                              pa.array(out_s, pa.int8())], names=["_id", "w", "_init"])
    return run


def windows_from_turns(turns: DataFrame, dialogs: DataFrame, lookup, source_name: str = "conversations",
                       seq_len: int = DEFAULT_SEQ_LEN, stride: int | None = None,
                       escape_specials: bool = False, keep_tail: bool = False,
                       mask_scope: str = "window") -> DataFrame:
    """F7 without assembling dialogs: ``turns(_id, _ord, _role, _text)`` of kept dialogs,
    ``dialogs(_id, _last)`` with the last turn key per dialog.

    Token counts per turn → exclusive prefix sums (range-partitioned, so one huge dialog
    spans many tasks) → tokens at their places (``placed_turns``) → each turn emits the slices it contributes to each
    overlapping window → ``groupBy(dialog, window)`` (≤ seq_len+1 tokens per group) →
    mask kernel.  Same output as ``build_windows`` (``keep_tail`` and both mask scopes).

    ``mask_scope='sample'``: each turn's last control-token state (a fold over its ids);
    the most recent earlier turn holding one is found through the same prefix sums
    (count of such turns) and an equi-join; a small kernel then gives the state just
    before every window start inside the turn.
    """
    stride = stride or seq_len // 2
    spark = turns.sparkSession
    ensure_package(spark)
    bc = broadcast_value(spark, lookup)
    sample_scope = mask_scope == "sample"
    pre = placed_turns(turns, dialogs, bc, escape_specials)
    lens = pre.where("_eos").select("_id", (F.col("g0") + 1).alias("L"))  # <eos> is a dialog's last token
    x = pre.join(lens, "_id")
    S = seq_len
    n_win = F.when(F.col("L") <= S + 1, F.lit(1)).otherwise(F.ceil((F.col("L") - S) / F.lit(stride)))
    w_lo = F.greatest(F.lit(0), F.ceil((F.col("g0") - S) / F.lit(stride)))
    w_hi = F.least(n_win - 1, F.floor((F.col("g0") + F.col("n") - 1) / F.lit(stride)))
    pieces = x.select("_id", "g0", "n", "ids", w_lo.cast("long").alias("lo"), w_hi.cast("long").alias("hi")) \
        .where(F.col("lo") <= F.col("hi")) \
        .select("_id", "g0", "n", "ids", F.explode(F.sequence("lo", "hi")).alias("w"))
    pieces = pieces.withColumn("_s", (F.col("w") * stride).cast("long"))
    if keep_tail:
        # one more window at L − S − 1 when the regular windows leave tokens after their end
        last_end = (n_win - 1) * stride + S + 1
        tail_start = F.col("L") - S - 1
        tail = x.where((F.col("L") > S + 1) & (last_end < F.col("L")) & (F.col("g0") + F.col("n") > tail_start)) \
            .select("_id", "g0", "n", "ids", n_win.cast("long").alias("w"), tail_start.cast("long").alias("_s"))
        pieces = pieces.unionByName(tail)
    s_w = F.col("_s")
    a = F.greatest(s_w, F.col("g0")) - F.col("g0")
    b = F.least(s_w + S + 1, F.col("g0") + F.col("n")) - F.col("g0")
    pieces = pieces.select("_id", "w", F.struct((F.greatest(s_w, F.col("g0")) - s_w).alias("off"),
                                                F.slice("ids", (a + 1).cast("int"), (b - a).cast("int")).alias("p"))
                           .alias("piece"))
    grouped = pieces.groupBy("_id", "w").agg(F.array_sort(F.collect_list("piece")).alias("ps"))
    tok = F.flatten(F.transform("ps", lambda p: p["p"]))
    padded = F.when(F.size(tok) < S + 1, F.concat(tok, F.array_repeat(F.lit(PAD_ID), S + 1 - F.size(tok)))) \
        .otherwise(tok)
    if sample_scope:
        ctl_turns = x.where(F.col("_has") == 1).select(
            F.col("_id").alias("_pid_"), F.col("_c").alias("_cidx"), F.col("_ls").alias("_pls"))
        xs = x.join(ctl_turns, (x["_id"] == ctl_turns["_pid_"]) & (ctl_turns["_cidx"] == x["_c"] - 1), "left") \
            .select("_id", "g0", "n", "ids", "L", F.coalesce(F.col("_pls"), F.lit(0)).alias("_sb"))
        inits = xs.mapInArrow(_init_state_kernel(S, stride, keep_tail), f"_id {_kind(xs, '_id')}, w long, _init tinyint")
        grouped = grouped.join(inits, ["_id", "w"], "left").withColumn(
            "_init", F.coalesce(F.col("_init"), F.lit(0).cast("tinyint")))
    cols = [F.concat(F.lit(source_name + ":"), F.col("_id").cast("string")).alias("sample_id"),
            F.col("w").cast("int").alias("window_no"), padded.alias("window")]
    if sample_scope:
        cols.append("_init")
    return grouped.select(*cols).mapInArrow(_mask_kernel(S), WINDOWS)


def turn_table_windows(turns: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
                       text_col: str = "text", source_name: str = "conversations", seq_len: int = DEFAULT_SEQ_LEN,
                       stride: int | None = None, max_turns: int = 10_000, max_chars: int = 64 << 20,
                       escape_specials: bool = False, keep_tail: bool = False, text_mask: str = "none",
                       mask_scope: str = "window"):
    """B7 → B6 → E1/E2 → F7 for a turn-per-row table, safe for dialogs of any size.

    Returns ``(windows, vocab)``.  One scan of the text yields both the vocabulary's
    characters and per-dialog stats (turns, assistant turns, characters); the small stats
    table is persisted.  Dialogs within ``max_turns`` and ``max_chars``
    are assembled and cut by the fused kernel (one row per dialog); larger ones go
    through ``windows_from_turns`` (no per-dialog row); both routes support every option and
    order turns that share a key by role and text.  Hot dialogs leave by a map-side anti-join
    before the exchange that gathers the others.  Ids may have any type.
    """
    from pyspark import StorageLevel

    from chatloom.operators.vocab import collect_lookup, dialog_profile, kept_chars, number_tokens
    from chatloom.operators.batches import dense_positions
    from chatloom.sources.tables import assemble_dialogs, dialog_key
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = turns.select(dialog_key(turns, id_col).alias("_id"), F.col(order_col).cast("long").alias("_ord"),
                     F.col(role_col).alias("_role"), F.col(text_col).alias("_text"))
    prof = dialog_profile(t).persist(StorageLevel.MEMORY_AND_DISK)
    dlg = prof.where(F.col("token").isNull()).groupBy("_id").agg(
        F.sum("_n").alias("_n"), F.sum("_na").alias("_na"), F.max("_last").alias("_last"),
        F.sum("_chars").alias("_chars")).persist(StorageLevel.MEMORY_AND_DISK)
    kept = dlg.where(F.col("_na") > 0)
    vocab = number_tokens(kept_chars(prof.where(F.col("token").isNotNull()).select("_id", "token"), kept)).cache()
    lookup = collect_lookup(vocab)
    prof.unpersist()
    is_hot = (F.col("_n") > max_turns) | (F.col("_chars") > max_chars)
    hot = kept.where(is_hot).select("_id", F.col("_n").alias("_last"))
    n_hot = hot.count()
    hot_ids = F.broadcast(hot.select("_id")) if n_hot <= HOT_BROADCAST_ROWS else hot.select("_id")
    cool = t.join(hot_ids, "_id", "left_anti") if n_hot else t
    tk = cool.repartition(n, "_id").join(kept.where(~is_hot).select("_id"), "_id")
    small = tk.select(F.col("_id").alias(id_col), F.col("_ord").alias(order_col), F.col("_role").alias(role_col),
                      F.col("_text").alias(text_col))
    samples = assemble_dialogs(small, id_col, order_col, role_col, text_col, source_name, repartition=False)
    out = build_windows(samples, lookup, seq_len, stride, keep_tail=keep_tail, text_mask=text_mask,
                        mask_scope=mask_scope, escape_specials=escape_specials)
    if n_hot:
        big = dense_positions(t.join(hot_ids, "_id", "left_semi"), ["_id"], ["_ord", "_role", "_text"], "_pos") \
            .select("_id", F.col("_pos").alias("_ord"), "_role", "_text")
        out = out.unionByName(windows_from_turns(big, hot, lookup, source_name, seq_len, stride, escape_specials,
                                                 keep_tail, mask_scope))
    return out, vocab
