"""Every core query that has SQL gives the rows that DuckDB gives for it."""

import os

import duckdb
import pytest

from voxloom.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


def rows(frame):
    frame = frame[sorted(frame.columns)]
    missing = frame.isna()
    out = []
    for r, m in zip(frame.itertuples(index=False), missing.itertuples(index=False), strict=True):
        out.append(tuple(None if n else round(float(v), 3) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v, n in zip(r, m, strict=True)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, duck, name):
    ours, theirs = QUERIES[name](spark, sf).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    a, b = rows(ours), rows(theirs)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert [v for v in x if not isinstance(v, float)] == [v for v in y if not isinstance(v, float)]
        assert [v for v in x if isinstance(v, float)] == pytest.approx([v for v in y if isinstance(v, float)], abs=2e-3)


def test_queries_without_sql_run(spark, sf):
    for name in set(QUERIES) - set(SQL) - {"signal_features"}:
        assert QUERIES[name](spark, sf).count() > 0
