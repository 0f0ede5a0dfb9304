"""Every registered query against its DuckDB oracle on the small tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidewell.plans import catalog
from tidewell.sources.fixtures import BASE_TABLES

QUERIES = dict(catalog.QUERIES)
ORACLES = dict(catalog.ORACLES)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_query_has_oracle_or_is_documented():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, duck, key):
    df = QUERIES[key](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[key])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == {d[0]: str(d[1]) for d in res.description}
    assert len(s_rows) == len(o_rows)
    assert _digest(df.columns, s_rows) == _digest(o_cols, o_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns
