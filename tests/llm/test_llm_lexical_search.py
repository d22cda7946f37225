import math
import random
import re
from collections import Counter

from llm_cases import clashing, documents

from chatloom.llm import lexical_search as op

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
VOCAB = [f"t{i}" for i in range(40)] + ["É", "é", "日本語", "don't", "a-b", "X", "x", "t1t2", "K"]  # the last is the Kelvin sign


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score)."""
    held = [(i, Counter(w), len(w)) for i, t in docs if (w := plain_terms(t))]
    big_n, big_l = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c, n in held:
            m = 25 + 75 * n * big_n // big_l
            score = 0
            for t in plain_terms(text):
                w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                score += w * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=lambda r: (r[0], r[1]))


def texts(rng, n, vocab=VOCAB, longest=60):
    return [rng.choice([" ", ", ", "\n", ". "]).join(rng.choices(vocab, k=rng.randint(0, longest))) for _ in range(n)]


def test_matches_brute_force(spark):
    rng = random.Random(4)
    docs = list(enumerate([None, "", "...", "T1", "one"] + texts(rng, 150)))
    docs += [(200 + i, docs[20][1]) for i in range(15)]  # equal scores rank by id
    items = list(enumerate([None, "", "!!", "zzz unknown", "É t1 T1 t1", "日本語 don't"] + texts(rng, 12, longest=8)))
    d = clashing(documents(spark, [t for _, t in docs[:-15]]).unionByName(documents(spark, [docs[20][1]] * 15, 200)), "doc", "n", "terms", "rank", "score", "item_id")
    i = clashing(spark.createDataFrame(items, "item_id long, text string"), "doc_id", "item", "term")
    want = plain_search(docs, items)
    got = op.search(d, i)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    assert sorted(map(tuple, op.search(d, i, block_bytes=40).collect())) == want  # several automata
    assert sorted(map(tuple, op.search(d.repartition(7), i, k=3).collect())) == plain_search(docs, items, 3)


def test_terms_are_whole_words_in_slices_of_a_long_text(monkeypatch):
    rng = random.Random(5)
    terms = [f"{i}".encode() for i in range(50)]
    words = [str(rng.randrange(400)) for _ in range(20_000)]
    monkeypatch.setattr(op, "SLICE", 1000)
    blanked = [" ".join(words).encode(), b"", b"7", b" 7  77 7 "]
    doc, term, tf = op._count_terms(op._automaton(terms), blanked, len(terms))
    want = [(d, int(t), n) for d, text in enumerate(blanked) for t, n in Counter(text.decode().split()).items() if int(t) < 50]
    assert sorted(zip(doc.tolist(), term.tolist(), tf.tolist())) == sorted(want)


def test_scores_in_chunks_and_beyond_doubles(spark, monkeypatch):
    rng = random.Random(6)
    docs, items = list(enumerate(texts(rng, 60))), list(enumerate(texts(rng, 5, longest=30)))
    block = op.Items(items)
    block.weigh(60, {})
    doc, term = [0, 0, 2], [0, 3, 1]
    import numpy as np
    args = (np.array(doc), np.array(term), np.array([5, 7, 11]), 3)
    quick = block.scores(*args)
    block.exact_in_doubles = False
    assert (quick == block.scores(*args)).all() and quick.any()
    monkeypatch.setattr(op, "CELLS", 20)
    assert [list(c) for c in op._chunks([5, 30, 1, 1, 1, 1, 1], 5)] == [[0, 1], [1, 2], [2, 6], [6, 7]]
    import pyarrow as pa
    found = [(d, len(plain_terms(t)), Counter(plain_terms(t))) for d, t in docs if plain_terms(t)]
    df = Counter(t for _, _, c in found for t in c)
    number = {t.decode(): i for i, t in enumerate(block.terms)}
    block.weigh(len(found), {number[t]: n for t, n in df.items() if t in number})
    rows = [(d, n, [number[t] for t in c if t in number], [x for t, x in c.items() if t in number]) for d, n, c in found]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                                       names=["doc", "n", "terms", "tfs"])
    shared = type("Shared", (), {"value": block})
    out = [r for b in op._rank_kernel(shared, len(found), sum(n for _, n, _ in found), 4)([batch, batch.slice(0, 0)]) for r in b.to_pylist()]
    got = sorted((block.ids[r["item"]], -r["score"], r["doc_id"]) for r in out)
    assert got == sorted((i, -s, d) for i, _, d, s in plain_search(docs, items, 4))


def test_empty_tables_null_ids_and_repeats(spark):
    empty = documents(spark, [])
    items = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "b")], "item_id long, text string")
    assert op.search(empty, items).collect() == [] and op.search(documents(spark, ["a"]), items.where("false")).collect() == []
    rows = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c"), (4, "c c"), (5, None)], "doc_id long, text string")
    got = sorted((str(r.item_id), r.rank, str(r.doc_id)) for r in op.search(rows, items).collect())
    assert got == sorted([("1", 1, "3"), ("1", 2, "3"), ("1", 3, "None")] * 2 + [("None", 1, "3"), ("None", 2, "3"), ("None", 3, "None")])
    assert op.search(documents(spark, ["?", None, ""]), items).collect() == []
