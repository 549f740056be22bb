"""Every registered query against its SQL in DuckDB on the given tables."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_point
from helpers import plan
from tallyframe.workload import all_queries
from tallyframe.workload.tables import SCHEMAS

QUERIES = {key: q.run for key, q in all_queries().items()}
ORACLE = entry_point.oracle_sql()
# no cross joins, and no rows leaving the JVM
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        raise AssertionError("results show money as doubles")
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    text = plan(df)
    assert not [name for name in UNWANTED if name in text]
    found = table(df.columns, df.collect())
    result = duck.execute(ORACLE[key])
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert found == table(columns, result.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
