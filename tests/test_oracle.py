"""Every registered query with an SQL twin gives DuckDB's rows."""

import glob
import math
import os

import duckdb
import pytest

from admill.plans import registry


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 7)
    if isinstance(value, (bool, int, str)):
        return float(value) if isinstance(value, int) and not isinstance(value, bool) else value
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{tiny}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*' if os.path.isdir(path) else ''}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, tiny, name):
    df = registry.QUERIES[name](spark, tiny)
    got = [tuple(r) for r in df.collect()]
    if name not in registry.ORACLES:
        assert got and len(df.columns) == len(set(df.columns))
        return
    result = duck.execute(registry.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, got) == rows(columns, result.fetchall())
