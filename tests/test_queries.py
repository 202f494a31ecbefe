"""Every registered query against its SQL on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from larder.bindings import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def ordered(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(row[i]) for i in at) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = database.execute(ORACLE_SQL[name])
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(names)
    got = df.collect()
    assert expected
    assert ordered(df.columns, got) == ordered(names, expected)


def test_entry(spark):
    assert entry(spark).columns == ["difficulty", "avg_total_cooking_time"]
    assert entry(spark).count() > 0
