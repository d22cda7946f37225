import random

import xxhash
from llm_cases import clashing, documents, simhash, simhash_groups
from pyspark.sql import functions as F

from chatloom.llm import simhash as op
from chatloom.llm.common import connected_components

VOCAB = [f"w{i}" for i in range(400)] + ["É", "ß", "ÀB"]


def corpus(n=150, seed=1):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "one", "One", "one two", "ONE  TWO", "É É"]
    for _ in range(n):
        words = rng.choices(VOCAB, k=rng.randint(1, 400))
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
        for _ in range(rng.randint(0, 3)):  # near and exact copies
            near = list(words)
            for _ in range(rng.randint(0, 2)):
                near[rng.randrange(len(near))] = rng.choice(VOCAB)
            texts.append(" ".join(near))
    return texts


def test_matches_brute_force(spark):
    texts = corpus()
    docs = clashing(documents(spark, texts), "fp", "rep", "key", "start", "component_id", "fingerprint", "component")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op.near_duplicates(docs).collect()}
    want = simhash_groups(list(enumerate(texts)))
    assert got == {i: (f"{simhash(t):016x}", want[i]) for i, t in enumerate(texts)}
    assert len(set(want.values())) < len(texts)


def test_every_pair_within_two_bits_is_linked(spark):
    base = 0x0123456789ABCDEF
    near = {base} | {base ^ (1 << a) for a in range(64)} | {base ^ (1 << a) ^ (1 << b) for a in range(0, 64, 5) for b in range(64) if a != b}
    fps = sorted(near)
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)]
    got = {(r.a, r.b) for r in op.ring_links(spark.createDataFrame(rows, "rep long, fp long")).collect()}
    want = {(i, j) for i, a in enumerate(fps) for j, b in enumerate(fps) if i < j and (a ^ b).bit_count() <= 2}
    assert got == want
    split = {(r.a, r.b) for r in op.ring_links(spark.createDataFrame(rows, "rep long, fp long"), split_over=3).collect()}
    assert split == want
    got = {(r.a, r.b) for r in op.ring_links(spark.createDataFrame(rows[:200], "rep long, fp long"), 3, 9).collect()}
    assert got == {(i, j) for i in range(200) for j in range(i + 1, 200) if (fps[i] ^ fps[j]).bit_count() <= 3}


def test_shingle_hash_is_that_of_spark(spark):
    h = spark.sql("select xxhash64('a b c') h").first().h
    assert op.fingerprint("A b\tc") == h


def test_long_text_read_whole_in_slices():
    rng = random.Random(3)
    text = " ".join(rng.choices(VOCAB, k=600_000))
    assert len(text) > 2 * op.CHUNK
    words = text.encode().lower().split()
    whole = [h for part in op.shingle_hashes(text, 3, 42) for h in part.tolist()]
    assert len(whole) == len(words) - 2
    assert whole == [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(len(words) - 2)]


def test_empty_table_null_ids_and_repeats(spark):
    empty = documents(spark, [])
    assert op.near_duplicates(empty).collect() == [] and op.keep_first(empty).collect() == []
    rows = spark.createDataFrame([(None, "a b c d", "x"), (5, "a b c d", "x"), (5, "a b c d", "x"), (9, "a b c d", "y"), (None, "q", "y"),
                                  (7, None, "z"), (8, "", "z")], "doc_id long, text string, component_id string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in op.near_duplicates(rows).collect())
    assert got == [("5", "5"), ("5", "5"), ("7", "7"), ("8", "7"), ("9", "5"), ("None", "5"), ("None", "None")]
    kept = sorted((str(r.doc_id), r.component_id) for r in op.keep_first(rows).collect())
    assert kept == [("5", "x"), ("7", "z"), ("None", "x"), ("None", "y")]


def test_rows_that_share_an_id_stay_by_their_own_text(spark):
    a, b, c = "one text of some words here", "quite another text with its words", "and a third one, unlike the others"
    schema = "doc_id long, text string, note string"
    rows = [(2, b, "x"), (5, a, "y"), (5, b, "z"), (7, c, "q"), (7, c, "p"), (7, a, "r"), (8, None, "n"), (8, "", "m")]
    for order in (rows, rows[::-1]):
        got = sorted(map(tuple, op.keep_first(spark.createDataFrame(order, schema).repartition(3)).collect()), key=repr)
        assert got == [(2, b, "x"), (5, a, "y"), (7, c, "p"), (8, None, "n")]


def test_components_of_a_chain_a_star_and_a_cycle(spark):
    n = 200
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, 50)] + [(3000, 2999), (2999, 2998), (2998, 3000)]
    random.Random(2).shuffle(edges)
    df = spark.createDataFrame(edges + [(7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    want = {i: 0 for i in range(n + 1)} | {1000 + i: 1000 for i in range(50)} | {i: 2998 for i in (2998, 2999, 3000)}
    assert got == want
    assert connected_components(df.where(F.lit(False))).collect() == []
