"""Every registered query against its SQL, run by DuckDB on the same tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as registered

SF = f"{TESTDATA}/sf0.001"
SQL = registered.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return float(value) + 0.0 if isinstance(value, (int, float)) else value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    result = registered.queries()[name](spark, SF)
    answer = duck.execute(SQL[name])
    names = [column[0] for column in answer.description]
    assert sorted(result.columns) == sorted(names)
    assert sorted_rows(result.columns, result.collect()) == sorted_rows(names, answer.fetchall())


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() == 272
