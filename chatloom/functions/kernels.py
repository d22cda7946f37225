"""Arrow/numpy kernels run inside ``mapInArrow`` tasks.

They hold the per-sample sequential logic (special-token scan, window cutting,
loss-mask state) that has no efficient built-in Spark expression.  Spark does
the partitioning, shuffles and aggregation around them; each kernel only sees
one Arrow batch at a time and emits bounded output batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from chatloom.schema import (
    ASSISTANT_ID,
    EOS_ID,
    PAD_ID,
    SPECIAL_TOKENS,
    UNK_ID,
    USER_ID,
)

SPECIAL_RE = re.compile("|".join(re.escape(s) for s in SPECIAL_TOKENS))
SPECIAL_INDEX = {s: i for i, s in enumerate(SPECIAL_TOKENS)}
ROLE_TOKEN = {"user": USER_ID, "assistant": ASSISTANT_ID}

# windows emitted per output batch: a single huge text must not become one giant batch
MAX_WINDOWS_PER_BATCH = 512


# code points or tokens that a kernel holds at a time, whatever an Arrow batch brings
HELD = 1 << 20


def row_slices(batch: pa.RecordBatch, column, limit: int = HELD) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch whose strings, lists or turns in ``column`` hold about ``limit`` values together.

    A single row may hold more.  Nothing is copied.
    """
    n = batch.num_rows
    if n == 0:
        return
    col = batch.column(column)
    if pa.types.is_list(col.type):
        offs = col.offsets.to_numpy()
        sizes = np.diff(offs)
        if pa.types.is_struct(col.type.value_type):
            turns = col.values.slice(offs[0], offs[-1] - offs[0])
            chars = pc.fill_null(pc.binary_length(turns.field("content")), 0).to_numpy(zero_copy_only=False)
            total = np.concatenate([[0], np.cumsum(chars)])
            sizes = sizes + np.diff(total[offs - offs[0]])
    else:
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes + 1, dtype=np.int64)
    lo = 0
    while lo < n:
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


class CharLookup:
    """Code point -> id lookup over a sorted array (vocabularies of any size)."""

    def __init__(self, chars, ids):
        cps = np.array([ord(c) for c in chars], dtype=np.int64)
        ids = np.asarray(ids, dtype=np.int32)
        order = np.argsort(cps, kind="stable")
        self.cps = cps[order]
        self.ids = ids[order]
        self._table = None

    @classmethod
    def from_vocab_rows(cls, rows):
        chars, ids = [], []
        for token, id_, special in rows:
            if not special and len(token) == 1:
                chars.append(token)
                ids.append(id_)
        return cls(chars, ids)

    def chars(self, s: str) -> np.ndarray:
        if not s:
            return np.empty(0, dtype=np.int32)
        if len(s) > HELD:
            return np.concatenate([self.chars(s[i:i + HELD]) for i in range(0, len(s), HELD)])
        cp = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return self._ids_by_code_point()[np.minimum(cp, len(self._table) - 1)]

    def _ids_by_code_point(self) -> np.ndarray:
        """Id of each code point up to the last known one, and of all beyond it (at most 4.5 MB, made in the task)."""
        if self._table is None:
            last = int(self.cps[-1]) if len(self.cps) else -1
            self._table = np.full(last + 2, UNK_ID, dtype=np.int32)
            self._table[self.cps] = self.ids
        return self._table

    def encode(self, s: str | None, escape_specials: bool = False) -> np.ndarray:
        """Left-to-right scan: a special string wins at its position, else one code point."""
        if not s:
            return np.empty(0, dtype=np.int32)
        if escape_specials or "<" not in s:
            return self.chars(s)
        pieces, pos = [], 0
        for m in SPECIAL_RE.finditer(s):
            if m.start() > pos:
                pieces.append(self.chars(s[pos:m.start()]))
            pieces.append(np.array([SPECIAL_INDEX[m.group()]], dtype=np.int32))
            pos = m.end()
        if pos < len(s):
            pieces.append(self.chars(s[pos:]))
        return np.concatenate(pieces) if pieces else np.empty(0, dtype=np.int32)

    def encode_dialog(self, roles, contents, escape_specials: bool = False) -> np.ndarray:
        parts = []
        for role, content in zip(roles, contents):
            marker = ROLE_TOKEN.get(role)
            if marker is not None:
                parts.append(np.array([marker], dtype=np.int32))
            parts.append(self.encode(content, escape_specials))
        parts.append(np.array([EOS_ID], dtype=np.int32))
        return np.concatenate(parts)


def window_starts(n_tokens: int, seq_len: int, stride: int, keep_tail: bool = False) -> np.ndarray:
    """Start offsets of the (seq_len+1)-token windows of one sample."""
    if n_tokens <= seq_len + 1:
        return np.zeros(1, dtype=np.int64)
    starts = np.arange(0, n_tokens - seq_len, stride, dtype=np.int64)
    if keep_tail and starts[-1] + seq_len + 1 < n_tokens:
        starts = np.append(starts, n_tokens - seq_len - 1)
    return starts


def loss_mask(inputs: np.ndarray, init_state: np.ndarray | None = None) -> np.ndarray:
    """Mask over a 2-D block of input windows.

    State machine per row: ``<assistant>`` switches supervision on (that position
    itself is 0), ``<user>`` and ``<eos>`` switch it off, every other token takes the
    current state.  ``init_state`` is the state before position 0 (all off by default).
    """
    n, s = inputs.shape
    ctl = np.full((n, s), -1, dtype=np.int8)
    ctl[inputs == ASSISTANT_ID] = 1
    ctl[(inputs == USER_ID) | (inputs == EOS_ID)] = 0
    pos = np.where(ctl >= 0, np.arange(s)[None, :], -1)
    last = np.maximum.accumulate(pos, axis=1)
    state = np.take_along_axis(ctl, np.maximum(last, 0), axis=1)
    init = np.zeros((n, 1), dtype=np.int8) if init_state is None else init_state.reshape(n, 1).astype(np.int8)
    state = np.where(last >= 0, state, init)
    return ((state == 1) & (inputs != ASSISTANT_ID)).astype(np.int8)


def _carry_state(tokens: np.ndarray, starts: np.ndarray, init: int = 0) -> np.ndarray:
    """Mask state just before each start (offsets into ``tokens``) when the state runs over the
    whole sample; ``init`` is the state before ``tokens[0]``."""
    ctl = np.full(len(tokens), -1, dtype=np.int8)
    ctl[tokens == ASSISTANT_ID] = 1
    ctl[(tokens == USER_ID) | (tokens == EOS_ID)] = 0
    pos = np.where(ctl >= 0, np.arange(len(tokens)), -1)
    last = np.maximum.accumulate(pos) if len(tokens) else pos
    out = np.full(len(starts), init, dtype=np.int8)
    ok = starts > 0
    prev = last[np.maximum(starts - 1, 0)] if len(tokens) else np.full(len(starts), -1)
    has = ok & (prev >= 0)
    out[has] = ctl[prev[has]] == 1
    return out


class WindowBuilder:
    """Accumulates windows of many samples and flushes bounded Arrow batches."""

    def __init__(self, seq_len, stride, keep_tail, text_mask, mask_scope, schema):
        self.S, self.stride, self.keep_tail = seq_len, stride, keep_tail
        self.text_mask, self.mask_scope = text_mask, mask_scope
        self.schema = schema
        self._reset()

    def _reset(self):
        self.ids, self.nos, self.rows = [], [], []
        self.n = 0

    def add(self, sample_id: str, tokens: np.ndarray, is_text: bool) -> Iterator[pa.RecordBatch]:
        yield from self.add_chunks(sample_id, [tokens], is_text)

    def _emit(self, sample_id, buf, base, starts, first_no, is_text, L, init):
        """Append windows at global ``starts`` (all inside ``buf``, which begins at ``base``)."""
        S = self.S
        rel = starts - base
        block = np.lib.stride_tricks.sliding_window_view(buf, S + 1)[rel]
        inputs = block[:, :-1]
        if is_text and self.text_mask == "all":
            # every real next-token prediction is supervised (L is known for the padded window only)
            mask = (np.arange(S)[None, :] + starts[:, None] < (L - 1 if L is not None else 1 << 62)).astype(np.int8)
        elif self.mask_scope == "sample":
            mask = loss_mask(inputs, _carry_state(buf, rel, init))
        else:
            mask = loss_mask(inputs)
        self.rows.append((block, mask))
        self.ids.extend([sample_id] * len(starts))
        self.nos.append(np.arange(first_no, first_no + len(starts), dtype=np.int32))
        self.n += len(starts)

    def add_chunks(self, sample_id: str, chunks, is_text: bool) -> Iterator[pa.RecordBatch]:
        """Windows of one sample whose tokens arrive in chunks (memory: one chunk + S + 1 tokens).

        A window starting at s is complete once s + S + 1 tokens are known, which is exactly
        the reference condition s < L − S; the total length L is only needed at the end
        (padding of a short sample, ``keep_tail``).
        """
        S, st = self.S, self.stride
        buf = np.empty(0, dtype=np.int32)
        base = 0            # global position of buf[0]
        next_start = 0
        n_out = 0
        last_start = -1
        init = 0            # mask state before buf[0] (mask_scope='sample')
        for ch in chunks:
            if len(ch) == 0:
                continue
            buf = np.concatenate([buf, ch]) if len(buf) else np.asarray(ch, dtype=np.int32)
            end = base + len(buf)
            if next_start + S + 1 <= end:
                starts = np.arange(next_start, end - S, st, dtype=np.int64)
                for lo in range(0, len(starts), MAX_WINDOWS_PER_BATCH):
                    part = starts[lo:lo + MAX_WINDOWS_PER_BATCH]
                    self._emit(sample_id, buf, base, part, n_out, is_text, None, init)
                    n_out += len(part)
                    if self.n >= MAX_WINDOWS_PER_BATCH:
                        yield self.flush()
                last_start = int(starts[-1])
                next_start = last_start + st
            # keep what later windows (and keep_tail) can still need: from min(next_start, end-S-1)
            keep_from = min(next_start, end - (S + 1))
            drop = keep_from - base
            if drop > 0:
                if self.mask_scope == "sample":
                    init = int(_carry_state(buf, np.array([drop]), init)[0])
                buf = buf[drop:]
                base = keep_from
        L = base + len(buf)
        if n_out == 0:
            # L <= S: one window padded with <pad> (L == S + 1 was emitted above)
            padded = np.concatenate([buf, np.full(S + 1 - L, PAD_ID, dtype=np.int32)])
            self._emit(sample_id, padded, 0, np.zeros(1, dtype=np.int64), 0, is_text, L, 0)
        elif self.keep_tail and last_start + S + 1 < L:
            self._emit(sample_id, buf, base, np.array([L - S - 1], dtype=np.int64), n_out, is_text, L, init)
        if self.n >= MAX_WINDOWS_PER_BATCH:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        S = self.S
        blocks = np.concatenate([b for b, _ in self.rows]) if self.rows else np.empty((0, S + 1), np.int32)
        masks = np.concatenate([m for _, m in self.rows]) if self.rows else np.empty((0, S), np.int8)
        n = len(blocks)
        offsets = pa.array(np.arange(0, (n + 1) * S, S, dtype=np.int32))
        inp = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(blocks[:, :-1]).ravel(), pa.int32()))
        tgt = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(blocks[:, 1:]).ravel(), pa.int32()))
        msk = pa.ListArray.from_arrays(offsets, pa.array(masks.ravel(), pa.int8()))
        nos = np.concatenate(self.nos) if self.nos else np.empty(0, np.int32)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(self.ids, pa.string()), pa.array(nos, pa.int32()), inp, tgt, msk], schema=self.schema
        )
        self._reset()
        return batch


SPECIAL_MAX = max(len(t) for t in SPECIAL_TOKENS)


def text_slices(s: str, size: int = 1 << 20):
    """Cut a long string into slices; never inside a special token (they start with '<')."""
    size = max(size, 2 * SPECIAL_MAX)
    n, i = len(s), 0
    while i < n:
        j = min(n, i + size)
        if j < n:
            k = s.rfind("<", max(i + 1, j - SPECIAL_MAX + 1), j)
            if k > i:
                j = k
        yield s[i:j]
        i = j


def _encode_chunks(lookup: CharLookup, s, escape_specials: bool):
    if not s:
        return
    if len(s) <= (1 << 20):
        yield lookup.encode(s, escape_specials)
        return
    for piece in text_slices(s):
        yield lookup.encode(piece, escape_specials)


def sample_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``row_slices`` of samples by the characters of their texts and dialogs."""
    parts = [batch]
    for c in ("text", "dialog"):
        if c in batch.schema.names:
            parts = [x for p in parts for x in row_slices(p, batch.schema.names.index(c))]
    yield from parts


def iter_sample_chunks(batch: pa.RecordBatch, lookup: CharLookup, escape_specials: bool):
    """Yield (sample_id, kind, iterator of token chunks) — the streaming form of ``iter_samples``."""
    cols = batch.schema.names
    sid = batch.column(cols.index("sample_id")).to_pylist()
    kind = batch.column(cols.index("kind")).to_pylist()
    texts = batch.column(cols.index("text")).to_pylist() if "text" in cols else [None] * len(sid)
    if "dialog" in cols:
        dcol = batch.column(cols.index("dialog"))
        offsets = dcol.offsets.to_numpy()
        valid = dcol.is_valid().to_numpy(zero_copy_only=False)
        turns = dcol.values.slice(offsets[0], offsets[-1] - offsets[0])  # of a slice, not of the batch it is cut from
        offsets = offsets - offsets[0]
        roles = turns.field("role").to_pylist()
        contents = turns.field("content").to_pylist()
    else:
        offsets, valid = None, None
    eos = np.array([EOS_ID], dtype=np.int32)

    def dialog_chunks(lo, hi):
        for role, content in zip(roles[lo:hi], contents[lo:hi]):
            marker = ROLE_TOKEN.get(role)
            if marker is not None:
                yield np.array([marker], dtype=np.int32)
            yield from _encode_chunks(lookup, content, escape_specials)
        yield eos

    def text_chunks(t):
        yield from _encode_chunks(lookup, t, escape_specials)
        yield eos

    for i in range(len(sid)):
        if offsets is not None and valid[i] and kind[i] == "dialog":
            yield sid[i], kind[i], dialog_chunks(offsets[i], offsets[i + 1])
        else:
            yield sid[i], kind[i], text_chunks(texts[i])


def iter_samples(batch: pa.RecordBatch, lookup: CharLookup, escape_specials: bool):
    """Yield (sample_id, kind, token array) for a batch of samples (text or dialog)."""
    cols = batch.schema.names
    sid = batch.column(cols.index("sample_id")).to_pylist()
    kind = batch.column(cols.index("kind")).to_pylist()
    texts = batch.column(cols.index("text")).to_pylist() if "text" in cols else [None] * len(sid)
    if "dialog" in cols:
        dcol = batch.column(cols.index("dialog"))
        offsets = dcol.offsets.to_numpy()
        valid = dcol.is_valid().to_numpy(zero_copy_only=False)
        turns = dcol.values.slice(offsets[0], offsets[-1] - offsets[0])  # of a slice, not of the batch it is cut from
        offsets = offsets - offsets[0]
        roles = turns.field("role").to_pylist()
        contents = turns.field("content").to_pylist()
    else:
        offsets, valid = None, None
    for i in range(len(sid)):
        if offsets is not None and valid[i] and kind[i] == "dialog":
            lo, hi = offsets[i], offsets[i + 1]
            toks = lookup.encode_dialog(roles[lo:hi], contents[lo:hi], escape_specials)
        else:
            toks = np.concatenate([lookup.encode(texts[i], escape_specials), np.array([EOS_ID], np.int32)])
        yield sid[i], kind[i], toks


# largest slice of one string turned into code points at once (bounds memory for huge texts)
CHAR_SLICE = 1 << 22


def distinct_code_points(strings) -> np.ndarray:
    """Sorted distinct code points of an iterable of strings (NULLs skipped)."""
    seen = np.empty(0, dtype=np.uint32)
    buf, size = [], 0
    for s in strings:
        if not s:
            continue
        for lo in range(0, len(s), CHAR_SLICE):
            piece = s[lo:lo + CHAR_SLICE]
            buf.append(piece)
            size += len(piece)
            if size >= CHAR_SLICE:
                cp = np.frombuffer("".join(buf).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                seen = np.union1d(seen, np.unique(cp))
                buf, size = [], 0
    if buf:
        cp = np.frombuffer("".join(buf).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        seen = np.union1d(seen, np.unique(cp))
    return seen
