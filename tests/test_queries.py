"""Every query of the library against its SQL in DuckDB, and the driver's entry."""

import math
from collections import Counter

import duckdb
import pytest

from portico.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ("customer", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return float(v) if isinstance(v, float) else str(v)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, df.collect()) == bag(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
