import math
import random
import zlib
from collections import Counter

import numpy as np
from llm_cases import clashing, documents, union

from chatloom.llm import lang_id as op
from chatloom.llm.charlm import CharModel, HashArray, code_points, letter_symbols

STEMS = {"aa": ["ka", "lo", "mi", "tu", "re"], "bb": ["sch", "ung", "zen", "öd", "ein"], "cc": ["ção", "lha", "ndo", "é", "quí"]}


def prose(lang, n, rng):
    return " ".join("".join(rng.choices(STEMS[lang], k=rng.randint(1, 4))) for _ in range(n))


def corpus(spark, seed=3):
    rng = random.Random(seed)
    return union([documents(spark, [prose(k, rng.choice([2, 10, 80]), rng) for _ in range(60)], 1000 * i, k) for i, k in enumerate(STEMS)])


def kneser_ney(texts, order, symbols):
    """p(symbol | history) by the textbook, from whole texts; unseen symbols share one place beside ``symbols``."""
    pad = " " * (order - 1)
    level = Counter(g for t in texts for s in [pad + t] for g in (s[i:i + order] for i in range(len(s) - order + 1)))
    levels = {order: level}
    for n in range(order - 1, 0, -1):
        level = Counter(g[1:] for g in level)
        levels[n] = level
    base = 1 / (symbols + 1)

    def p(history, c):
        n = len(history) + 1
        counts = levels[n]
        low = p(history[1:], c) if n > 1 else base
        after = {g: k for g, k in counts.items() if g[:-1] == history}
        if not after:
            return low
        one, two = (sum(k == x for k in counts.values()) for x in (1, 2))
        d = min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.5
        total = sum(after.values())
        return max(after.get(history + c, 0) - d, 0) / total + d * len(after) / total * low
    return p


def test_model_equals_the_textbook():
    rng = random.Random(1)
    texts = {k: [prose(k, 12, rng) for _ in range(3)] for k in STEMS}
    counts = {k: Counter(g for t in ts for s in ["  " + t] for g in (s[i:i + 3] for i in range(len(s) - 2))) for k, ts in texts.items()}
    m = CharModel.build(counts, 3, "kn")
    probe = ["ka lo", "schung x", "ção q", "zzz", "k"]
    sums, sizes = m.score([code_points(t) for t in probe])
    symbols = len({c for ts in texts.values() for t in ts for c in t})
    for j, k in enumerate(m.labels):
        p = kneser_ney(texts[k], 3, symbols)
        for i, t in enumerate(probe):
            s = "  " + t
            want = sum(math.log(p(s[n - 2:n], s[n])) for n in range(2, len(s)))
            assert abs(want - sums[i, j]) < 1e-3 and sizes[i] == len(t)


def test_held_out_accuracy_and_contract(spark):
    docs = corpus(spark)
    models = op.fit(docs)
    got = op.identify(clashing(docs.drop("n_chars"), "score", "held_out", "lang_pred"), models).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len(held) > 15 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.lang_pred in STEMS and not r.rejected for r in got)


def test_only_text_and_the_learning_folds_count(spark):
    docs = corpus(spark)
    lies = docs.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 5 = 0 then 'lie' else lang end lang", "'z' source")
    a = op.identify(docs, op.fit(docs)).collect()
    b = op.identify(lies, op.fit(lies)).collect()
    assert sorted(a) == sorted(b)


def test_null_empty_letterless_gibberish_and_very_long_texts(spark):
    docs = corpus(spark)
    models = op.fit(docs)
    rng = random.Random(9)
    noise = "".join(rng.choices("xwjyqvf", k=4000))
    odd = documents(spark, [None, "", "123 !?", " \n", prose("bb", 200_000, rng), noise, "ka"])
    got = {r.doc_id: r for r in op.identify(odd.unionByName(odd), models).collect()}
    assert [(got[i].lang_pred, got[i].score, got[i].rejected) for i in range(4)] == [("und", 0.0, True)] * 4
    assert got[4].lang_pred == "bb" and not got[4].rejected and got[5].rejected and got[6].lang_pred == "aa"
    kept = sorted(r.doc_id for r in op.keep_identified(clashing(odd, "rejected"), models).collect())
    assert kept == [4, 6]
    # the end of a text counts as its start does
    mixed = documents(spark, [prose("aa", 100, rng) + " " + prose("cc", 10_000, rng)])
    assert op.identify(mixed, models).first().lang_pred == "cc"


def test_nothing_to_learn_null_ids_and_empty_table(spark):
    blank = spark.createDataFrame([(1, "ka lo", None), (None, "ka", "aa")], "doc_id long, text string, lang string")
    got = op.identify(blank, op.fit(blank)).collect()
    assert {(r.lang_pred, r.rejected) for r in got} == {("und", True)} and not any(r.held_out for r in got if r.doc_id is None)
    docs = corpus(spark)
    assert op.identify(docs.where("false"), op.fit(docs)).collect() == []
    assert op.identify(docs.where("false"), op.fit(docs.where("false"))).collect() == []
    one = docs.where("lang = 'aa'")
    assert {r.score for r in op.identify(one, op.fit(one)).collect()} == {1.0}


def test_hash_array_and_symbols():
    keys = np.unique(np.random.RandomState(0).randint(0, 1 << 62, 5000).astype(np.uint64) * np.uint64(3))
    a = HashArray(keys)
    assert (a.find(keys) == np.arange(len(keys))).all()
    assert (a.find(keys + np.uint64(1)) == np.where(np.isin(keys + np.uint64(1), keys), 0, -1)).all()
    assert (HashArray(np.empty(0, dtype=np.uint64)).find(keys) == -1).all()
    assert bytes(letter_symbols("Ab,, 12 É!").astype(np.uint8)) == b"ab \xe9 " and len(letter_symbols("1 2")) == 0


def test_too_many_labels_are_an_error(spark):
    import pytest

    from chatloom.llm import lang_id as op
    docs = spark.range(60).selectExpr("id doc_id", "concat('text ', id) text", "concat('l', id) lang")
    with pytest.raises(ValueError):
        op.fit(docs, max_langs=20)
