"""Keyed changes of versioned tables against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators.versioned import VersionedTable

SCHEMA = "id long, part string, gone string, row double"
CHANGES = f"{SCHEMA}, at long, op string"


def plain_merge(old, changes, keys=(0, 1)):
    def key(row):
        return tuple(row[k] for k in keys)

    latest = {}
    for change in changes:
        held = latest.get(key(change))
        if held is None or change[4] > held[4]:
            latest[key(change)] = change
    left = [row if key(row) not in latest else latest[key(row)] for row in old]
    left += [change for k, change in latest.items() if k not in {key(row) for row in old}]
    return [row[:4] for row in left if len(row) == 4 or row[5] != "d"]


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_merges_one_after_the_other(spark, tmp_path, partition_by):
    """NULL keys, repeated old rows, columns named like those used within."""
    rng = random.Random(4)

    def key():
        return rng.choice([None, *range(40)]), rng.choice(["a", "b", None])

    old = [(*key(), "x", float(n)) for n in range(60)]
    df = spark.createDataFrame(old, SCHEMA).repartition(5)
    table = VersionedTable.create(spark, f"{tmp_path}/t", df, partition_by=partition_by)
    for step in range(3):
        changes = [
            (*key(), f"new {step}", None if n % 7 == 0 else float(n), n, rng.choice("cud"))
            for n in range(30)
        ]
        table.merge(
            spark.createDataFrame(changes, CHANGES), ["ID", "part"], last_by="at", deletes="op = 'd'"
        )
        old = plain_merge(old, changes)
        assert rows(table.read()) == sorted(old, key=repr)
    assert [row.operation for row in table.snapshots().collect()].count("overwrite") == 3


def test_only_touched_files_are_rewritten(spark, tmp_path):
    df = spark.range(0, 1000, 1, 10).select("id", F.lit("x").alias("v"))
    table = VersionedTable.create(spark, f"{tmp_path}/t", df)
    table.merge(spark.createDataFrame([(5, "y"), (2000, "z")], "id long, v string"), ["id"])
    summary = table.snapshots().orderBy(F.desc("committed_at")).first().summary
    assert summary["deleted-data-files"] == "1"
    assert summary["total-records"] == "1001"
    changed = table.read().where("v <> 'x'")
    assert rows(changed) == [(2000, "z"), (5, "y")]


def test_into_an_empty_table_and_with_no_changes(spark, tmp_path):
    schema = spark.range(0).select("id", F.lit("x").alias("v")).schema
    table = VersionedTable.create(spark, f"{tmp_path}/t", schema)
    table.merge(spark.createDataFrame([(1, "a")], "id long, v string"), ["id"])
    assert rows(table.read()) == [(1, "a")]
    table.merge(spark.createDataFrame([], "id long, v string"), ["id"])
    assert rows(table.read()) == [(1, "a")]
    table.merge(spark.createDataFrame([(1, "a")], "id long, v string"), ["id"], deletes="true")
    assert rows(table.read()) == []


def test_two_changes_of_a_key(spark, tmp_path):
    table = VersionedTable.create(spark, f"{tmp_path}/t", spark.range(3).select("id", F.lit("x").alias("v")))
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id long, v string")
    with pytest.raises(PySparkException, match="two changes"):
        table.merge(twice, ["id"])
    assert table.read().where("v <> 'x'").count() == 0
    table.merge(twice, ["id"], last_by="v")
    assert rows(table.read().where("id = 1")) == [(1, "b")]
    with pytest.raises(ValueError, match="keys"):
        table.merge(twice, [])
