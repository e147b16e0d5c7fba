"""Event time on small streams, subtotals and ranks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators.grouping import cube, first_of_each, subtotals
from millrace.streaming.sinks import AVAILABLE_NOW, stream_to_parquet
from millrace.streaming.windows import (
    join_within,
    late_rows,
    sessions,
    stream_window_totals,
    window_totals,
    without_replays,
)

NOON = dt.datetime(2024, 1, 1, 12)
SCHEMA = "at timestamp, who string"


def at(minute):
    return NOON + dt.timedelta(minutes=minute)


def add(spark, path, *found, schema=SCHEMA):
    spark.createDataFrame(list(found), schema).coalesce(1).write.mode("append").parquet(path)


def follow(spark, path, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_rows_are_counted_apart(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"

    def run():
        query = stream_window_totals(
            follow(spark, source),
            "at",
            "10 minutes",
            ["who"],
            {"n": F.count("*")},
            target,
            f"{tmp_path}/check",
            "30 minutes",
            AVAILABLE_NOW,
        )
        query.awaitTermination()
        return late_rows(query)

    add(spark, source, (at(0), "a"), (at(1), "a"), (at(61), None), (None, "a"))
    assert run() == 0
    # the watermark stands at minute 31: one is late, one is not
    add(spark, source, (at(5), "a"), (at(40), "b"), (at(62), None))
    assert run() == 1
    found = window_totals(spark, target, ["who"]).select("window_start", "who", "n")
    assert rows(found) == sorted([(at(0), "a", 2), (at(60), None, 2), (at(40), "b", 1)], key=repr)


def test_sessions_of_a_table(spark):
    df = spark.createDataFrame(
        [(at(0), "a"), (at(9), "a"), (at(20), "a"), (at(3), "b"), (at(13), "b"), (at(9), None), (None, "a")], SCHEMA
    )
    found = sessions(df, "at", "10 minutes", ["who"], {"n": F.count("*")}, "1 hour")
    expected = [(at(0), at(19), "a", 2), (at(20), at(30), "a", 1), (at(3), at(23), "b", 2), (at(9), at(19), None, 1)]
    assert rows(found) == sorted(expected, key=repr)


def test_outer_rows_come_out_when_the_bound_has_passed(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "at timestamp, who string, kind string"

    def run():
        events = follow(spark, source, schema)
        left = events.where("kind <> 'r'").select(F.col("at").alias("l"), F.col("who").alias("lw"))
        right = events.where("kind <> 'l'").select(F.col("at").alias("r"), F.col("who").alias("rw"))
        joined = join_within(left, right, {"lw": "rw"}, ("l", "r"), "5 MINUTES", "1 minute", "leftOuter")
        stream_to_parquet(joined, target, f"{tmp_path}/check", AVAILABLE_NOW).awaitTermination()
        return rows(spark.read.schema(joined.schema).parquet(target).where("lw <> 'beat'"))

    add(spark, source, (at(0), "a", "l"), (at(0), "b", "l"), (at(4), "a", "r"), (at(9), "b", "r"), schema=schema)
    matched = (at(0), "a", at(4), "a")
    assert run() == [matched]
    add(spark, source, (at(60), "beat", "both"), schema=schema)
    assert run() == sorted([matched, (at(0), "b", None, None)], key=repr)


def test_names_of_joined_sides_must_differ(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="both sides"):
        join_within(df, df, {"who": "who"}, ("at", "at"), "1 HOUR", "1 hour")


def test_replays(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "timestamp timestamp, topic string, partition int, offset long, value string"
    first = [(at(n), "t", n % 2, n, f"v{n}") for n in range(10)]
    add(spark, source, *first, schema=schema)
    add(spark, source, *first[3:], (at(11), "t", 0, 11, "v11"), *first[3:5], schema=schema)
    kept = without_replays(follow(spark, source, schema), "1 hour")
    stream_to_parquet(kept, target, f"{tmp_path}/check", AVAILABLE_NOW).awaitTermination()
    values = sorted(row["value"] for row in spark.read.parquet(target).collect())
    assert values == sorted([*(f"v{n}" for n in range(10)), "v11"])


def test_nulls_of_data_and_of_subtotals(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, "x", 4)], "k string, l string, n int")
    found = cube(df, ["k", "l"], {"n": F.sum("n")})
    expected = [
        ("a", None, 0, 1), ("a", "x", 0, 2), (None, "x", 0, 4), ("a", None, 1, 3),
        (None, None, 1, 4), (None, None, 2, 1), (None, "x", 2, 6), (None, None, 3, 7),
    ]
    assert rows(found) == sorted(expected, key=repr)
    assert subtotals(df.limit(0), [["k"], []], {"n": F.count("*")}).collect() == []
    with pytest.raises(ValueError, match="no column"):
        subtotals(df, [[]], {"n": F.sum("n")})


def test_first_of_each_limits_ahead_of_the_shuffle(spark):
    df = spark.range(0, 5000, 1, 8).select((F.col("id") % 3 == 0).alias("hot"), (F.col("id") % 1000).alias("v"), "id")
    best = first_of_each(df, ["hot"], [F.desc("v"), "id"], 2)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [(r.hot, r.v, r["rank"]) for r in best.orderBy("hot", "rank").collect()] == [
        (False, 999, 1), (False, 999, 2), (True, 999, 1), (True, 999, 2),
    ]
    tied = first_of_each(df, ["hot"], [F.desc("v")], 1, ties=True)
    assert tied.count() == 5
    with pytest.raises(ValueError, match="rank"):
        first_of_each(best, ["hot"], ["id"], 1)


def test_state_is_on_disk_and_lasts_over_restarts(spark, tmp_path):
    source, target, check = (f"{tmp_path}/{name}" for name in ("in", "out", "check"))
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)

    def run():
        found = sessions(follow(spark, source), "at", "10 minutes", ["who"], {"n": F.count("*")}, "30 minutes")
        query = stream_to_parquet(found, target, check, AVAILABLE_NOW)
        query.awaitTermination()
        assert spark.conf.get(store) == before
        stores = [state for progress in query.recentProgress for state in progress.stateOperators]
        assert stores
        assert all(any(name.startswith("rocksdb") for name in state.customMetrics) for state in stores)
        return rows(spark.read.schema(found.schema).parquet(target).where("who IS DISTINCT FROM 'beat'"))

    add(spark, source, (at(0), "a"), (at(3), "b"), (at(20), None))
    assert run() == []
    add(spark, source, (at(9), "a"), (at(13), "b"), (at(25), "b"))
    assert run() == []
    add(spark, source, (at(90), "beat"))
    expected = [(at(0), at(19), "a", 2), (at(3), at(23), "b", 2), (at(20), at(30), None, 1), (at(25), at(35), "b", 1)]
    assert run() == sorted(expected, key=repr)
    assert not list(tmp_path.glob("check/state/*/[0-9]*/.*.crc"))


def test_streams_go_on_with_the_store_they_began_with(spark, tmp_path):
    source, target, check = (f"{tmp_path}/{name}" for name in ("in", "out", "check"))
    add(spark, source, (at(0), "a"), (at(20), "b"))
    found = sessions(follow(spark, source), "at", "10 minutes", ["who"], {"n": F.count("*")}, "30 minutes")
    writer = found.writeStream.format("parquet").option("path", target).option("checkpointLocation", check)
    writer.trigger(availableNow=True).start().awaitTermination()
    add(spark, source, (at(9), "a"))
    add(spark, source, (at(90), "beat"))
    stream_to_parquet(found, target, check, AVAILABLE_NOW).awaitTermination()
    expected = [(at(0), at(19), "a", 2), (at(20), at(30), "b", 1)]
    assert rows(spark.read.parquet(target)) == sorted(expected, key=repr)
