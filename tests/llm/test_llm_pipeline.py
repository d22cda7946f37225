import os
import shutil
import subprocess
import sys

import duckdb
import pytest
from llm_cases import clashing, held_items, mixed, simhash_groups, span_clean, word_size
from conftest import SF001

import __spark_entry__ as E
import corpus_pipeline as P
from chatloom.llm import lang_id
from chatloom.llm import queries as Q

REPO = os.path.dirname(os.path.abspath(E.__file__))


def test_run_equals_brute_force_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    models = lang_id.fit(docs)
    kept = {i: r.text for (i, r), p in zip(rows.items(), models.predict([r.text for r in rows.values()])) if not p[3]}
    assert len(kept) >= 0.98 * len(rows)  # clean documents stay
    groups = simhash_groups(sorted(kept.items()))
    kept = {i: t for i, t in kept.items() if groups[i] == i}
    clean = span_clean(sorted(kept.items()))
    kept = {i: t for i, (t, n, gone) in clean.items() if not gone or gone < n}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    held = {d for d, _ in held_items(sorted(kept.items()), bench)}
    kept = {i: t for i, t in kept.items() if i not in held}
    want = {i: n for i, n in mixed([(i, t, rows[i].source) for i, t in kept.items()]).items() if n}
    out = P.run(spark, SF001)
    assert out.columns == [*docs.columns, "mix_copy", "mix_words"]
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.mix_words
        assert kept[r.doc_id].startswith(r.text) and word_size(r.text) == r.mix_words and r.n_chars == len(r.text)
    assert got == want and held


def test_stages_keep_columns_and_take_awkward_rows(spark):
    docs = clashing(spark.read.parquet(f"{SF001}/documents.parquet").limit(60), "score", "fp", "span", "_text2")
    odd = spark.createDataFrame([(None, "some words here", None, None, None), (-1, None, None, None, None), (-2, "", "en", "s", 0),
                                 (-2, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF001).columns == docs.columns, name
        stage(spark, docs, SF001).collect()
        assert stage(spark, docs.where("false"), SF001).collect() == [], name
    assert P.STAGES[-1][1](spark, docs.where("false"), SF001).collect() == []
    assert P.STAGES[-1][1](spark, docs, SF001).columns == [*docs.columns, "mix_copy", "mix_words"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "conversations", "pages", "benchmark", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_queries_against_their_oracles(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*cols).collect()]
    table = {"op1": "pages", "op3": "conversations", "op10": "embeddings", "op12": "pages"}.get(name.split("_")[0], "documents")
    if name not in ("op6_decontaminate", "op11_lexical_search", "op13_filter_audit"):
        assert len(rows) == con.sql(f"SELECT count(*) FROM {table}").fetchall()[0][0]
    sql = E.oracle_sql().get(name)
    if sql:
        rel = con.sql(sql)
        assert sorted(rel.columns) == cols
        at = [rel.columns.index(c) for c in cols]
        assert sorted(map(repr, rows)) == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())


def test_entry_works_without_the_subpackage(tmp_path):
    shutil.copytree(f"{REPO}/chatloom", tmp_path / "chatloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q), q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
