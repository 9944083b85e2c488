"""Corpus queries against their SQL twins, and that all are registered."""

import re

import pytest

import __spark_entry__ as contract
from compare import SAME_TYPE, connect, duck_rows, spark_rows
from tripstats.llm import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_all_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", x)[1]) for x in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())
    assert set(queries.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows(spark, duck, name):
    columns, rows = spark_rows(queries.QUERIES[name](spark, SF_DIR))
    duck_columns, expected = duck_rows(duck, queries.SQL[name])
    assert [c for c, _ in columns] == [c for c, _ in duck_columns]
    for (column, spark_type), (_, duck_type) in zip(columns, duck_columns):
        assert duck_type in {**SAME_TYPE, "boolean": {"BOOLEAN"}}[spark_type], column
    assert sum(expected.values()) > 0
    assert rows == expected
