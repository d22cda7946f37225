"""Every query of the chat catalog against its DuckDB oracle at sf0.001 (order-insensitive)."""

import duckdb
import pytest

import __spark_entry__ as E
from chatloom.plans import registry
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    rows = sorted(tuple(_norm(x) for x in r) for r in df.select(*cols).collect())
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert rows == want


def test_entry_smoke(spark):
    r = E.entry(spark).collect()
    assert len(r) == 1 and r[0].n_windows == 270
