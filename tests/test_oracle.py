"""Every query of the catalogue against its SQL, run by DuckDB on the same tables."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from keytables.plans.catalog import CATALOG

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_sql(spark, duck, name):
    got = queries()[name](spark, FOLDER)
    found = duck.execute(oracle_sql()[name])
    want_columns, want = _rows([c[0] for c in found.description], found.fetchall())
    got_columns, have = _rows(got.columns, got.collect())
    assert got_columns == want_columns
    assert sum(have.values()) == sum(want.values())
    assert have == want


def test_entry(spark):
    assert entry(spark).count() > 0
