"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from tallyframe.sources.tables import TABLES

from conftest import SF_SMALL

SQL = E.oracle_sql()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    dcols, dtypes = rel.columns, [str(t) for t in rel.types]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    spark_types = dict(df.dtypes)
    assert {c: TYPES.get(t, t) for c, t in zip(dcols, dtypes)} == {c: spark_types[c] for c in dcols}
    assert len(rows) == len(drows)
    assert _canon(df.columns, rows) == _canon(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["n_test", "accuracy"]
    assert df.count() == 1
