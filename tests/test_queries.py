"""Every catalogued query against the second engine, on the supplied tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from ratelake.plans import catalog, oracle

from .conftest import SF

QUERIES, SQL = catalog.queries(), oracle.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
# Whole runs write every table of the engine; test_runs.py covers them in more detail.
SLOW = {"daily_run", "backfill_run", "pipeline_backfill"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in SLOW])
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    result = duck.sql(SQL[name])
    assert sorted(result.columns) == columns
    at = [result.columns.index(c) for c in columns]
    for c, i in zip(columns, at):
        assert str(result.types[i]) == TYPES[df.schema[c].dataType.simpleString()], c
    want = sorted(repr([plain(r[i]) for i in at]) for r in result.fetchall())
    assert got == want


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "country_name" in df.columns
