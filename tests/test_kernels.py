"""Pure kernel semantics (no Spark): encoding, window cutting, loss masks."""

import numpy as np

from chatloom.functions.kernels import CharLookup, WindowBuilder, loss_mask, window_starts
from chatloom.operators.windows import _arrow_schema


def lookup(chars="abc中😀<>usre"):
    uniq = sorted(set(chars))
    return CharLookup(uniq, list(range(7, 7 + len(uniq))))


def test_one_id_per_code_point_and_unknown():
    lk = lookup("a中😀")
    ids = lk.encode("a中😀x")
    assert len(ids) == 4
    assert ids[-1] == 1                      # unknown char -> <unk>
    assert len(set(ids[:3].tolist())) == 3


def test_specials_are_control_tokens_unless_escaped():
    lk = lookup("ab<>useraistn")
    assert lk.encode("a<user>b").tolist() == [lk.encode("a")[0], 4, lk.encode("b")[0]]
    assert lk.encode("<eos><unk>").tolist() == [3, 1]
    esc = lk.encode("a<user>b", escape_specials=True)
    assert len(esc) == 8 and 4 not in esc.tolist()


def test_dialog_markers_and_single_eos():
    lk = lookup("ab")
    ids = lk.encode_dialog(["system", "user", "assistant", "tool"], ["a", "b", "a", "b"]).tolist()
    a, b = lk.encode("a")[0], lk.encode("b")[0]
    assert ids == [a, 4, b, 5, a, b, 3]


def test_window_counts_and_padding():
    S, stride = 256, 128
    expect = {256: 1, 257: 1, 258: 1, 384: 1, 385: 2, 513: 3}
    for L, n in expect.items():
        assert len(window_starts(L, S, stride)) == n, L
        if L > S + 1:
            assert len(window_starts(L, S, stride)) == int(np.ceil((L - S) / stride))
    # pads: 256 tokens -> 1 pad, 257 -> 0
    schema = _arrow_schema()
    for L, pads in ((256, 1), (257, 0)):
        wb = WindowBuilder(S, stride, False, "none", "window", schema)
        list(wb.add("s", np.arange(7, 7 + L, dtype=np.int32) % 50 + 7, True))
        b = wb.flush()
        row = b.column("input_ids")[0].as_py() + [b.column("target_ids")[0].as_py()[-1]]
        assert len(row) == S + 1 and row.count(0) == pads


def test_first_window_mask_example():
    inp = np.array([[4, 9, 5, 10, 11, 3] + [0] * 250], dtype=np.int32)
    m = loss_mask(inp)[0].tolist()
    assert m[:7] == [0, 0, 0, 1, 1, 0, 0] and sum(m) == 2


def test_text_mask_none_and_all():
    schema = _arrow_schema()
    toks = np.array([7, 8, 9, 3], dtype=np.int32)
    for mode, expected in (("none", 0), ("all", 3)):
        wb = WindowBuilder(8, 4, False, mode, "window", schema)
        list(wb.add("t", toks, True))
        assert sum(wb.flush().column("loss_mask")[0].as_py()) == expected


def test_mask_scope_sample_carries_state():
    schema = _arrow_schema()
    toks = np.array([4, 7, 5] + [8] * 20 + [3], dtype=np.int32)   # assistant answer spans windows
    got = {}
    for scope in ("window", "sample"):
        wb = WindowBuilder(8, 8, False, "none", scope, schema)
        list(wb.add("d", toks, False))
        got[scope] = [sum(x) for x in wb.flush().column("loss_mask").to_pylist()]
    assert got["window"][1] == 0 and got["sample"][1] == 8


def test_keep_tail():
    assert window_starts(300, 256, 128).tolist() == [0]
    assert window_starts(300, 256, 128, keep_tail=True).tolist() == [0, 43]


def _rows(wb):
    b = wb.flush()
    return list(zip(b.column("sample_id").to_pylist(), b.column("window_no").to_pylist(),
                    b.column("input_ids").to_pylist(), b.column("target_ids").to_pylist(),
                    b.column("loss_mask").to_pylist()))


def test_chunked_windows_equal_whole_array():
    rng = np.random.default_rng(0)
    schema = _arrow_schema()
    for L in [1, 5, 16, 17, 18, 40, 41, 97, 300]:
        toks = rng.choice([3, 4, 5, 7, 8, 9, 10], size=L).astype(np.int32)
        for stride in (3, 8, 16):
            for keep_tail in (False, True):
                for scope in ("window", "sample"):
                    for text_mask in ("none", "all"):
                        ref = WindowBuilder(16, stride, keep_tail, text_mask, scope, schema)
                        # reference: whole array in one chunk
                        list(ref.add_chunks("s", [toks], True))
                        cuts = sorted(rng.choice(np.arange(1, L), size=min(5, L - 1), replace=False)) if L > 1 else []
                        pieces = np.split(toks, cuts)
                        got = WindowBuilder(16, stride, keep_tail, text_mask, scope, schema)
                        list(got.add_chunks("s", iter(pieces), True))
                        assert _rows(got) == _rows(ref), (L, stride, keep_tail, scope, text_mask)


def test_window_counts_match_reference_formula_when_chunked():
    schema = _arrow_schema()
    for L in (256, 257, 258, 384, 385, 513, 1000):
        wb = WindowBuilder(256, 128, False, "none", "window", schema)
        toks = np.full(L, 7, dtype=np.int32)
        list(wb.add_chunks("s", iter(np.array_split(toks, 7)), True))
        assert wb.n == len(window_starts(L, 256, 128))


def test_text_slices_never_split_specials():
    from chatloom.functions.kernels import text_slices
    lk = lookup("ab<>useraistnpdkbocq")
    s = ("ab<assistant>" * 50 + "<user>x<eos>" * 30 + "<<sep>>" * 20) * 3
    for size in (1, 5, 11, 12, 13, 22, 23, 37, 100):
        pieces = list(text_slices(s, size))
        assert "".join(pieces) == s
        enc = np.concatenate([lk.encode(p) for p in pieces])
        assert enc.tolist() == lk.encode(s).tolist(), size
