"""Every query with SQL against DuckDB on the smallest tables, and the entry point."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from platter.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    flat = [tuple(round(r[k], 6) if isinstance(r[k], float) else r[k] for k in order) for r in rows]
    return sorted(map(repr, flat))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, DATA), duck.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical([tuple(r) for r in ours.collect()], ours.columns) == canonical(theirs.fetchall(), theirs.columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
