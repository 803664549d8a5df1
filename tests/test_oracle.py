"""Every registered query against its SQL in DuckDB, on whole tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from martloom import catalogue
from martloom.oracle import ORACLE_SQL

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events".split()
EMPTY = {"orphan_products", "unmatched_transactions"}

# The corpus operators have their own tests.
QUERIES, SQL = {n: contract.queries()[n] for n in catalogue.QUERIES}, {n: contract.oracle_sql()[n] for n in ORACLE_SQL}

# DuckDB type -> Spark type, both as reported.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def _canonical(row, columns):
    return tuple(str(v) if not isinstance(v, float) else repr(v) for _, v in sorted(zip(columns, row)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = df.collect()
    if name not in SQL:
        assert rows
        return
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    kinds = {d[0]: str(d[1]).upper() for d in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    for column, kind in df.dtypes:
        assert TYPES.get(kinds[column], kinds[column].lower().replace(" ", "")) == kind, column
    assert bool(rows) == (name not in EMPTY)
    got = Counter(_canonical(tuple(r), df.columns) for r in rows)
    want = Counter(_canonical(r, columns) for r in expected)
    assert got == want


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["supplierID", "supplierName", "Year", "Quarter", "Month", "TotalSales"]
    assert df.limit(1).collect()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
