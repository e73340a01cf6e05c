"""Every registered query against its SQL counterpart in DuckDB, at the smallest scale."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_points  # noqa: E402
from checks.oracles import ORACLES  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("pages", "events", "documents"):
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    rows = QUERIES[name](spark, str(FOLDER))
    columns = sorted(rows.columns)
    found = Counter(tuple(row[c] for c in columns) for row in rows.collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert found == Counter(tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall())


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert entry_points.queries().items() >= QUERIES.items()
    assert entry_points.oracle_sql().items() >= ORACLES.items()


def test_flagship_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
