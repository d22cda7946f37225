import random

import numpy as np
import pytest
from llm_cases import clashing, documents, held_items

from chatloom.llm import decontaminate as op

VOCAB = [f"x{i}" for i in range(3000)] + ["é", "Ünder", "中文"]
ITEMS = "item_id long, text string"


def words_of(text):
    return op.word_hashes(np.frombuffer(text.encode(), dtype=np.uint8))


def fixture(seed=5):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices(VOCAB, k=rng.randint(1, 60)))) for i in range(40)] + [(100, None), (101, ""), (102, "!?"), (103, "solo")]
    texts = [None, "", "...", "solo"]
    for _ in range(150):
        parts = rng.choices(VOCAB, k=rng.randint(0, 300))
        if rng.random() < 0.7:
            mine = rng.choice(items[:40])[1].split()
            for _ in range(rng.randint(0, max(0, len(mine) // 4))):
                kind, at = rng.randint(0, 2), rng.randrange(len(mine) or 1)
                mine[at:at + (kind != 1)] = [] if kind == 0 else [rng.choice(VOCAB)]
                if not mine:
                    break
            at = rng.choice([0, len(parts), rng.randint(0, len(parts))])
            parts[at:at] = [w.upper() + rng.choice(["", ",", "!"]) for w in mine]
        texts.append(" ".join(parts))
    return items, texts


def test_against_brute_force(spark):
    items, texts = fixture()
    docs = clashing(documents(spark, texts), "item_id", "n_edits", "first_word", "block")
    got = op.find_items(docs, clashing(spark.createDataFrame(items, ITEMS), "doc_id", "lang")).collect()
    found = {(r.doc_id, r.item_id): r.n_edits for r in got}
    want = held_items(list(enumerate(texts)), items)
    assert len(found) == len(got) and found.items() <= want.items()  # none but matches, with the least edits
    assert len(found) >= 0.99 * len(want) and len(want) > 60
    assert {k for k, e in want.items() if e == 0} <= set(found)


def test_keep_clean_leaves_clean_documents(spark):
    items, texts = fixture(6)
    docs = documents(spark, texts)
    left = {r.doc_id for r in op.keep_clean(docs, spark.createDataFrame(items, ITEMS)).collect()}
    held = {d for d, _ in held_items(list(enumerate(texts)), items)}
    assert not left & {d for (d, _), e in held_items(list(enumerate(texts)), items).items() if e == 0}
    assert set(range(len(texts))) - held <= left


def test_word_hashes_across_pieces():
    rng = random.Random(1)
    text = " ".join("y" * rng.randint(1, 30) + str(rng.randint(0, 99)) for _ in range(12_000)) + " " + "z" * (3 * op.PIECE) + " end"
    words = text.split()
    want = [int(words_of(w)[0]) for w in dict.fromkeys(words)]
    one = dict(zip(dict.fromkeys(words), want))
    got = words_of(text)
    assert len(got) == len(words)
    assert got.tolist() == [one[w] for w in words]  # wherever a word stands
    assert len(words_of("")) == 0 and len(words_of("?!")) == 0
    assert (words_of("Big RED") == words_of("big, red!")).all()


def test_very_long_text_null_ids_repeats_and_empty_tables(spark):
    items, _ = fixture()
    q = spark.createDataFrame(items + [items[5]], ITEMS)
    long = "pad " * 300_000 + items[5][1] + " pad" * 1000
    rows = spark.createDataFrame([(1, long), (2, items[5][1]), (2, items[5][1]), (None, items[5][1])], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_edits) for r in op.find_items(rows, q).where("item_id = 5").collect())
    assert got == [("1", 0), ("2", 0), ("2", 0), ("None", 0)]
    assert op.keep_clean(rows, q).count() == 0
    none = spark.createDataFrame([], "doc_id long, text string")
    assert op.find_items(none, q).collect() == [] and op.find_items(rows, q.where("false")).collect() == []
    assert op.keep_clean(rows, q.where("item_id >= 100 and item_id < 103")).count() == 4


@pytest.mark.parametrize("edits", [0, 3, 8])
def test_walks_reach_the_recall_target(edits):
    rng = random.Random(edits)
    items = [(i, words_of(" ".join(rng.choices(VOCAB, k=40)))) for i in range(50)]
    block = op.Block(items, 0.8, 0.99)
    hit = 0
    for i, w in items:
        made = w.copy()
        made[rng.sample(range(40), edits)] = np.uint64(12345)
        got = block.matches(made, np.array([0, 40]))
        hit += got.get((0, i), (99,))[0] == edits
    assert hit >= 48


def test_lengths_that_no_number_of_walks_serves_are_verified_in_full(spark, monkeypatch):
    items, texts = fixture(7)
    want = held_items(list(enumerate(texts)), items)
    monkeypatch.setattr(op, "MAX_WALKS", 0)  # no length with edits reaches the target
    block = op.Block([(i, words_of(t)) for i, t in items if t], 0.8, 0.99)
    assert {n for n, k in block.keys.items() if k is None} == {n for n in block.keys if op.allowed_edits(n, 0.8)}
    found = {}
    for doc, text in enumerate(texts):
        w = words_of(text or "")
        found |= {(doc, block.items[i][0]): p[0] for (_, i), p in block.matches(w, np.array([0, len(w)])).items()}
    assert found == want


def test_each_length_reaches_the_target(spark):
    rng = random.Random(9)
    items = [(n, words_of(" ".join(rng.choices(VOCAB, k=n)))) for n in (5, 9, 24, 60, 400)]
    block = op.Block(items, 0.8, 0.99)
    for n, w in items:
        d, hit = op.allowed_edits(n, 0.8), 0
        for _ in range(60):
            made = w.copy()
            made[rng.sample(range(n), d)] = np.array([rng.randrange(1, 1 << 62) for _ in range(d)], dtype=np.uint64)
            hit += any(block.items[i][0] == n for _, i in block.matches(made, np.array([0, n])))
        assert hit >= 57, (n, hit, len(block.keys[n] or ()))


def test_several_blocks_find_what_one_finds(spark, monkeypatch):
    items, texts = fixture(8)
    docs, bench = documents(spark, texts), spark.createDataFrame([*items, (None, items[3][1])], ITEMS)
    one = sorted(map(str, op.find_items(docs, bench).collect()))
    monkeypatch.setattr(op, "BLOCK_CHARS", 2000)
    many = sorted(map(str, op.find_items(docs, bench).collect()))
    assert len(one) > 50 and abs(len(many) - len(one)) <= 2  # a block fits its own numbers of walks
