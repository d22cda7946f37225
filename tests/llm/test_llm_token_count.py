import random

import pytest
from llm_cases import clashing, documents

from chatloom.llm import token_count as op

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")
ALPHABET = list(" \n\t\r\x0b\x0c\x1c\x1d\x85\xa0\u1680\u180e\u2003\u200b\u2028\u202f\u3000\ufeffab'sSdéßÀ中文ёЖ12²½Ⅷ٣.,!?_-—’́🙂\x00") + \
    ["<|endoftext|>", "<|endof", "'ll", " '", "'re", "  "]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    return lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)


def texts(seed=2):
    rng = random.Random(seed)
    out = [None, "", " ", "<|endoftext|>", "a<|endoftext|> b", "word " * 40, "x" * 5000]
    for i in range(600):
        out.append("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 25))))
        out.append("".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0x3000, 0xD800), rng.randrange(0xE000, 0x20000)]))
                           for _ in range(8)))
    return out


def test_counts_are_the_librarys(spark, library):
    rows = texts()
    docs = clashing(documents(spark, rows), "n_tokens", "n_bytes", "piece")
    got = {r.doc_id: r for r in op.count_tokens(docs, PATH, limit=50).collect()}
    for i, t in enumerate(rows):
        assert (got[i].n_bytes, got[i].n_tokens) == (len((t or "").encode()), library(t)), repr(t)
        assert got[i].over_limit == (got[i].n_tokens > 50)


def test_tiers_agree_and_caches_stay_bounded(spark, library, monkeypatch):
    rows = texts(3)
    full = op.Counts(PATH, {})
    frequent = op.frequent_lengths(documents(spark, rows), PATH)
    assert frequent and all(n == library(p) for p, n in list(frequent.items())[:200])
    monkeypatch.setattr(op, "CACHE", 50)
    small = op.Counts(PATH, dict(list(frequent.items())[:20]))
    for t in rows:
        assert small.count(t) == full.count(t)
        assert len(small.new) <= 100 and len(small.old) <= 100


def test_very_long_text_is_read_whole(library, monkeypatch):
    monkeypatch.setattr(op, "LONG", 1000)
    rng = random.Random(4)
    counts = op.Counts(PATH, {})
    for alphabet in (ALPHABET, list("ab cd é.\n1")):
        t = "".join(rng.choice(alphabet) for _ in range(20_000))
        assert counts.count(t) == library(t)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in op.count_tokens(rows, PATH).collect())
    assert got == [("1", 3, 2, False), ("1", 3, 2, False), ("None", 0, 0, False)]
    assert op.count_tokens(rows.where("false"), PATH).collect() == []


def test_files_of_another_kind_are_given_whole_texts(spark, tmp_path):
    import json

    from tokenizers import Tokenizer
    other = PATH.replace("byte_bpe_50k.json", "word_bpe_49k.json")
    assert op.cuts_like_this(PATH) and not op.cuts_like_this(other)
    made = json.load(open(PATH, encoding="utf-8"))
    made["pre_tokenizer"]["add_prefix_space"] = True
    prefixed = str(tmp_path / "prefixed.json")
    json.dump(made, open(prefixed, "w", encoding="utf-8"))
    texts = [None, "", "Hello  WORLD don't", "é日本 <|endoftext|> x", "a\n\n b\t", "word " * 500]
    for path in (other, prefixed):
        tok = Tokenizer.from_file(path)
        got = {r.doc_id: r.n_tokens for r in op.count_tokens(documents(spark, texts), path).collect()}
        assert got == {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
