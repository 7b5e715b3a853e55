"""Every query of the core library against its SQL counterpart: columns, rows and exact values."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tillwise.workload.oracle import ORACLE
from tillwise.workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir_small):
    connection = duckdb.connect()
    for file in Path(sf_dir_small).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, sf_dir_small, name):
    frame = QUERIES[name](spark, sf_dir_small)
    cursor = duck.execute(ORACLE[name])
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    assert sorted(frame.columns) == sorted(names)
    actual = frame.collect()
    assert len(actual) == len(expected)
    assert len(actual) > 0
    assert _sorted(actual, frame.columns) == _sorted(expected, names)


def test_flagship_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "store_id"
    assert not frame.isEmpty()
