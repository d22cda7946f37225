import random

from llm_cases import blank_words, clashing, divided, documents, span_clean

from chatloom.llm import span_dedup as op

PASSAGE = ("The river runs past the old mill and the miller counts his sacks by candle light every single night. "
           "Nobody in the village has ever asked him why he does so! He would not know what to answer, as his father did the same. "
           "And so the years go by in the valley, one much like the other, until the water stops.")


def sentence(rng):
    words = rng.choices([f"v{i}" for i in range(30)] + ["naïve", "v.2", "語"], k=rng.choice([1, 2, 5, 9, 13, 55]))
    return rng.choice([" ", "  ", "\t"]).join(words) + rng.choice([". ", "! ", "\n", "?\n\n", " v.2 w. ", "। ", "。", ".\r\n", ", "])


def corpus(n=80, seed=6):
    rng = random.Random(seed)
    pool = [[sentence(rng) for _ in range(6)] for _ in range(10)]
    pool.append(["".join(rng.choices("天地玄黄宇宙洪荒日月盈昃", k=rng.choice([4, 20]))) + rng.choice("。！？") for _ in range(8)])
    pool.append(["the " * 70, "a b " * 40])
    texts = [None, "", "\n \n", "One.", " \n\nlead. in. text. "]
    for _ in range(n):
        parts = [sentence(rng) for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 2)):
            at, p = rng.randint(0, len(parts)), rng.choice(pool)
            parts[at:at] = p if rng.random() < 0.5 else [x.upper() for x in p]
        texts.append("".join(parts))
    return texts + texts[-5:]


def test_matches_brute_force(spark):
    texts = corpus()
    docs = clashing(documents(spark, texts), "doc", "span", "repeats", "first", "n_removed", "_x")
    got = {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in op.remove_repeats(docs).collect()}
    want = span_clean(list(enumerate(texts)))
    assert got == want and sum(w[2] for w in want.values()) > 100


def test_passage_stays_once_and_clean_texts_stay(spark):
    rng = random.Random(8)
    fill = [" ".join(rng.choices([f"u{i}" for i in range(5000)], k=12)) + ". " for _ in range(400)]
    clean = ["".join(fill[i * 10:i * 10 + 10]) for i in range(20)]
    planted = ["".join(fill[200 + i * 8:204 + i * 8]) + PASSAGE + "\n" + "".join(fill[204 + i * 8:208 + i * 8]) for i in range(20)]
    one = "word " * 60 + "end. "  # a passage of a single sentence
    docs = documents(spark, clean + planted + ["".join(fill[380:384]) + one + "\n" + fill[390], fill[391] + one + "\n" + fill[392]])
    out = {r.doc_id: r.text for r in op.remove_repeats(docs).collect()}
    assert [out[i] for i in range(20)] == clean
    assert sum("candle light" in t for t in out.values()) == 1 and "candle light" in out[20]
    assert sum("until the water stops" in t for t in out.values()) == 1
    assert out[41].count("word") <= 12 and out[41].startswith(fill[391]) and out[41].endswith(fill[392])


def test_sentences_are_those_of_the_plain_version():
    for t in corpus(200, 7):
        words = blank_words(t or "")
        data = (t or "").encode()
        bounds, _ = op.sentence_spans(data, 3, 30, 12, 3)
        got = [data[a:z].decode() for a, z in zip(bounds, bounds[1:])]
        assert got == ["".join("".join(words[n]) for n in s) for s in divided(words)]


def test_passage_pasted_in_mid_sentence_on_both_sides(spark):
    """55 words without a whole sentence, behind and before other words of the same line."""
    rng = random.Random(11)
    word = [f"u{i}" for i in range(3000)]
    passage = " ".join(rng.choices(word, k=55))
    texts = [" ".join(rng.choices(word, k=rng.randint(0, 40))) + f" {passage} " + " ".join(rng.choices(word, k=rng.randint(0, 40))) for _ in range(40)]
    got = {r.doc_id: r for r in op.remove_repeats(documents(spark, texts)).collect()}
    assert got[0].text == texts[0]
    for i in range(1, 40):
        left = set(got[i].text.split()) & set(passage.split())
        assert got[i].n_removed >= 3 and len(left) < 30  # the rims of the passage may stay with their neighbours
    assert {len(t.split()) - len(got[i].text.split()) >= 28 for i, t in enumerate(texts) if i} == {True}


def test_one_word_again_and_again_and_scripts_without_blanks(spark):
    chars = "".join(random.Random(2).choices([chr(c) for c in range(0x4E00, 0x5000)], k=60))
    texts = ["Start here: " + "the " * 80, "And there " + "the " * 90, "前文" + chars + "。后", "别" + chars]
    got = {r.doc_id: r.text for r in op.remove_repeats(documents(spark, texts)).collect()}
    assert got[0].count("the") < 80 and got[1].count("the") <= 24 and got[2] == texts[2] and len(got[3]) < 25


def test_long_text_repeated_rows_null_ids_and_empty_table(spark):
    long = "".join(f"sentence number {i} of a very long text goes on. " for i in range(40_000))
    docs = documents(spark, [long, "Short one. " + long[:3000]]).unionByName(documents(spark, [long]))
    got = op.remove_repeats(docs).collect()
    assert [r.n_removed for r in sorted(got, key=lambda r: (r.doc_id, r.n_removed))][:2] == [0, 0]
    assert next(r for r in got if r.doc_id == 1).n_removed > 50
    empty = documents(spark, [])
    assert op.remove_repeats(empty).collect() == [] and op.clean_corpus(empty).collect() == []
    three = "Alpha beta gamma delta epsilon one two three four five. Zeta eta theta iota kappa six seven eight nine ten. Lambda mu nu xi omicron a b c d e. "
    rows = spark.createDataFrame([(None, three), (3, three), (None, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text or "-") for r in op.remove_repeats(rows).collect()) == [("3", three), ("None", "-"), ("None", "-")]


def test_clean_corpus_keeps_columns(spark):
    three = "Alpha beta gamma delta epsilon one two three four five. Zeta eta theta iota kappa six seven eight nine ten. Lambda mu nu xi omicron a b c d e. "
    docs = clashing(documents(spark, [three, three, three + "More.", None, ""]), "n_removed")
    out = {r.doc_id: r for r in op.clean_corpus(docs).collect()}
    assert op.clean_corpus(docs).columns == docs.columns
    assert sorted(out) == [0, 2, 3, 4] and out[2].text == "More." and out[2].n_chars == 5 and out[0].n_removed == "extra"
