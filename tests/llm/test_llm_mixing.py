import random

import pytest
from conftest import SF001
from llm_cases import clashing, mixed, targets, union, word_size

from chatloom.llm import mixing as op

SCHEMA = "doc_id long, text string, source string"


def corpus(seed=4):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 7, 30, 200])), rng.choice(["a", "b", "c", "d", "é", "Z", None, "a", "a"])) for i in range(400)]
    return rows + [(1000, None, "a"), (1001, " \t\n", "b"), (1002, "x y z", "empty?"), (1003, None, "nothing"), (1004, "v " * 20_000, "c")]


def test_matches_brute_force(spark):
    rows = corpus()
    df = clashing(spark.createDataFrame(rows, SCHEMA), "size", "key", "rows", "target", "range", "taken")
    got = op.mix(df, rows_per_range=16).collect()
    assert {r.doc_id: r.taken for r in got} == mixed(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + word_size(t)
    goal = targets(sizes)
    for r in got:
        assert r.size == word_size(dict((i, t) for i, t, _ in rows)[r.doc_id]) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goal[r.source]) and r.taken <= 2 * r.size
    for s, g in goal.items():
        assert abs(sum(r.taken for r in got if r.source == s) - g) < 1
    assert sum(goal.values()) == pytest.approx(1.5 * sum(sizes.values()))
    again = op.mix(spark.createDataFrame(random.Random(1).sample(rows, len(rows)), SCHEMA)).collect()
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in got}


def test_native_plan(spark, capsys):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    op.materialise(docs).explain("formatted")
    op.mix(docs).explain("formatted")
    op.source_targets(docs.selectExpr("source", "n_chars size")).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_materialised_words_and_copies(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "cast(length(text) as long) n_chars", "'x' mix_copy")
    out = op.materialise(df, rows_per_range=16).collect()
    assert out[0].asDict().keys() == {"doc_id", "text", "source", "n_chars", "mix_copy", "mix_words"}
    took, texts = {}, dict((i, t) for i, t, _ in rows)
    for r in out:
        took[r.doc_id] = took.get(r.doc_id, 0) + r.mix_words
        assert word_size(r.text) == r.mix_words and texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert took == {i: n for i, n in mixed(rows).items() if n}


def test_empty_table_repeated_rows_and_null_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.mix(empty).collect() == [] and op.materialise(empty).collect() == []
    blank = spark.createDataFrame([(1, None, None), (None, "", "a")], SCHEMA)
    assert [r.taken for r in op.mix(blank).collect()] == [0, 0] and op.materialise(blank).collect() == []
    same = spark.createDataFrame([(1, "a b c", "s")] * 4 + [(None, "a b", "s")] * 2, SCHEMA)
    got = op.mix(same).collect()
    assert len(got) == 6 and sum(r.taken for r in got) == 24 and all(r.taken <= 2 * r.size for r in got)
    assert abs(sum(r.mix_words for r in op.materialise(same).collect()) - 24) <= 6


def test_one_source_alone_takes_the_share(spark):
    rows = [(i, "a b c d", "only") for i in range(100)]
    got = op.mix(union([spark.createDataFrame(rows, SCHEMA)])).collect()
    assert {r.target for r in got} == {600.0} and sum(r.taken for r in got) == 600
