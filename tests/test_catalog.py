"""Every registered query against its checking SQL, at the smallest scale."""

import math
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables here")

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def checker():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return float(value) if isinstance(value, Decimal) else value


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_checking_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_sql(spark, checker, name):
    result = entry.queries()[name](spark, str(TABLES))
    columns = sorted(result.columns)
    cursor = checker.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    wanted = [tuple(plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall()]
    got = [tuple(plain(row[c]) for c in columns) for row in result.collect()]
    assert ordered(got) == ordered(wanted)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).columns == ["event_id", "user_id", "rolling_avg", "is_anomaly"]
