import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, norm

from conftest import SF_SMALL

def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["uid", "rank", "mid", "score"]


def test_every_query_has_an_oracle():
    q, o = set(E.queries()) - set(E.LLM_QUERIES), set(E.oracle_sql()) - set(E.LLM_QUERIES)
    assert o == q


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle_on_small_tables(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    a = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    b = sorted((tuple(norm(v) for _, v in sorted(zip(rel.columns, r))) for r in rel.fetchall()), key=repr)
    assert a == b
