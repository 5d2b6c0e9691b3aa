"""Every registered query against its SQL, on the smallest tables."""

import datetime
import math

import duckdb
import pytest
from conftest import TINY

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{TINY}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return f"{type(value).__name__}:{value}"


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, oracle, name):
    frame = contract.queries()[name](spark, TINY)
    found = frame.collect()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert found
        return
    answer = oracle.execute(sql)
    titles = [column[0] for column in answer.description]
    assert sorted(titles) == sorted(frame.columns)
    order = sorted(titles)
    places = [titles.index(title) for title in order]
    expected = sorted(tuple(plain(row[place]) for place in places) for row in answer.fetchall())
    assert sorted(tuple(plain(row[title]) for title in order) for row in found) == expected


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
