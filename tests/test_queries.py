"""Every registered query against its check SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from millrace.plans.registry import CHECK_SQL as CHECKS
from millrace.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def checker():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        return "NULL" if isinstance(value, float) and math.isnan(value) else repr(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, checker, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = checker.execute(CHECKS[name])
    names = [column[0] for column in relation.description]
    assert sorted(df.columns) == sorted(names)
    found = _canonical(df.columns, df.collect())
    assert found == _canonical(names, relation.fetchall())
    assert found


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "l_orderkey"


def test_every_query_has_check_sql():
    assert CHECKS.keys() == QUERIES.keys()
    assert QUERIES.items() <= __spark_entry__.queries().items()
    assert CHECKS.items() <= __spark_entry__.oracle_sql().items()
