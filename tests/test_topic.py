from __future__ import annotations

import datetime as dt
import json
import logging
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import rows
from millrace.functions.messages import (
    CORRUPT,
    from_json_payload,
    json_payload,
    parse_json_payloads,
)
from millrace.operators.versioned import VersionedTable
from millrace.sources.listing import list_objects
from millrace.sources.topic import (
    ENVELOPE,
    at_least_partitions,
    next_offset,
    read_topic,
    stream_topic,
    write_topic,
)
from millrace.streaming.progress import RowCountLogger, running_totals
from millrace.streaming.sinks import (
    AVAILABLE_NOW,
    stream_to_parquet,
    stream_with_counts,
    topic_table_path,
    topic_to_json_files,
    topic_to_table,
)
from millrace.workspace import remove_path

AB = StructType().add("a", "long").add("b", "string")


def _messages(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "value STRING")
    return df.withColumn("value", F.col("value").cast("binary"))


def _json_topic(spark, path, n, start=0, files=1):
    df = spark.range(start, start + n, 1, files).select(
        F.col("id").alias("a"), F.concat(F.lit("é"), "id").alias("b")
    )
    write_topic(df.select(json_payload().alias("value")), path, "t")
    return df


def test_envelope(spark, tmp_path):
    path = str(tmp_path / "t")
    _json_topic(spark, path, 100, files=4)
    messages = read_topic(spark, path)
    assert messages.schema == ENVELOPE
    counts = messages.groupBy("partition").count()
    assert [r[1] for r in counts.collect()] == [10] * 10 or counts.count() == 10
    first = next_offset(spark, path)
    _json_topic(spark, path, 50, start=100, files=2)
    later = read_topic(spark, path).where(F.col("offset") >= first)
    assert later.count() == 50
    assert read_topic(spark, path).select("offset").distinct().count() == 150


def test_key_decides_the_partition(spark, tmp_path):
    """Also when one key has a third of all messages."""
    path = str(tmp_path / "t")
    df = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.col("id").cast("string").alias("value"),
    )
    write_topic(df, path, "t", partitions=4)
    messages = read_topic(spark, path)
    places = messages.groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert rows(places.select("n").distinct()) == [(1,)]
    assert messages.select("offset").distinct().count() == 3000
    plan = df.select(F.monotonically_increasing_id())._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


def test_json_keeps_nulls_and_micros(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b")
    assert bytes(df.select(json_payload()).first()[0]) == b'{"a":1,"b":null}'
    times = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00.000001' AS t")
    sent = times.select(json_payload().alias("value"))
    assert rows(sent.select(from_json_payload("value", times.schema).getField("t"))) == rows(times)


def test_malformed_null_and_all_null_messages_differ(spark):
    sent = _messages(spark, '{"a":1,"b":"x"}', '{"a":', None, '{"a":null}', '{"a":"text"}')
    before = AB.fieldNames()
    data = sent.select(from_json_payload("value", AB).alias("d"))
    assert AB.fieldNames() == before
    out = data.select(F.col("d").isNull(), f"d.{CORRUPT}").collect()
    assert [tuple(r) for r in out] == [
        (False, None), (False, '{"a":'), (True, None), (False, None), (False, '{"a":"text"}')
    ]
    split = parse_json_payloads(sent.where("value IS NOT NULL"), AB)
    assert rows(split.where(F.col(CORRUPT).isNull()).drop(CORRUPT)) == [(1, "x"), (None, None)]
    with pytest.raises(Exception, match="(?i)malformed"):
        sent.select(from_json_payload("value", AB, mode="FAILFAST")).collect()


def test_messages_are_parsed_once_when_filtered(spark):
    split = parse_json_payloads(_messages(spark, '{"a":1}'), AB).where(F.col(CORRUPT).isNull())
    plan = split.select("a")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_restart_continues_and_repeats_nothing(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / name) for name in ("t", "out", "ck"))

    def run():
        data = from_json_payload("value", AB, mode="FAILFAST").alias("d")
        parsed = stream_topic(spark, topic, files_per_batch=2).select(data).select("d.*")
        query = stream_to_parquet(parsed, out, checkpoint, AVAILABLE_NOW)
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress]

    one = _json_topic(spark, topic, 40, files=4)
    assert run() == [20, 20]
    two = _json_topic(spark, topic, 10, start=40)
    assert sum(run()) == 10
    assert sum(run()) == 0
    sent = one.union(two)
    stored = spark.read.parquet(out)
    assert stored.exceptAll(sent).count() == sent.exceptAll(stored).count() == 0


@pytest.mark.parametrize("trigger", [None, {"processingTime": "1 second"}])
def test_triggers_run_until_stopped(spark, tmp_path, trigger):
    topic, out = str(tmp_path / "t"), str(tmp_path / "out")
    _json_topic(spark, topic, 30, files=3)
    query = stream_to_parquet(stream_topic(spark, topic), out, str(tmp_path / "ck"), trigger)
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.read.parquet(out).count() == 30


def test_json_files_roll_and_skip_tombstones(spark, tmp_path):
    topic, out = str(tmp_path / "t"), tmp_path / "out"
    df = _json_topic(spark, topic, 2500)
    extra = _messages(spark, None, "null", '{"a":\n7,"b":"x"}').coalesce(1)
    write_topic(extra, topic, "t")
    topic_to_json_files(
        stream_topic(spark, topic).withColumn("partition", F.lit(3)),
        str(out), str(tmp_path / "ck"), records_per_file=1000, trigger=AVAILABLE_NOW,
    ).awaitTermination()
    sizes = [len(f.read_text().splitlines()) for f in out.glob("topic=t/partition=3/part-*")]
    assert max(sizes) == 1000 and sum(sizes) == 2501
    lines = [json.loads(line) for f in out.glob("topic=t/partition=3/part-*")
             for line in f.read_text().splitlines()]
    assert {"a": 7, "b": "x"} in lines
    assert sorted(r["a"] for r in lines) == sorted([r.a for r in df.collect()] + [7])
    assert list_objects(spark, str(out), "part-*").count() == len(sizes)


def test_topic_table_name():
    assert topic_table_path("/w/", "shop", "raw.", "new-orders") == "/w/shop/raw_new_orders"


def test_topic_to_table_one_snapshot_per_batch(spark, tmp_path):
    topic, root, checkpoint = (str(tmp_path / name) for name in ("t", "table", "ck"))

    def run():
        topic_to_table(
            stream_topic(spark, topic, files_per_batch=1),
            from_json_payload("value", AB, mode="FAILFAST"),
            root, checkpoint, AVAILABLE_NOW,
        ).awaitTermination()

    df = _json_topic(spark, topic, 30, files=3)
    write_topic(_messages(spark, None), topic, "t")
    run()
    table = VersionedTable(spark, root)
    assert rows(table.read()) == rows(df)
    made = table.snapshots().count()
    assert made >= 3
    stream = json.loads((tmp_path / "ck" / "metadata").read_text())["id"]
    assert table.append(df, batch=(stream, made - 1)) is False
    assert table.append(df, batch=("another", 0)) is True
    run()
    assert VersionedTable(spark, root).row_count() == 60


def test_row_counts_of_a_stream(spark, tmp_path, caplog):
    caplog.set_level(logging.INFO, logger="millrace.streaming.progress")
    topic = str(tmp_path / "t")
    _json_topic(spark, topic, 40, files=4)
    listener = RowCountLogger()
    spark.streams.addListener(listener)
    try:
        query = stream_to_parquet(
            stream_topic(spark, topic, files_per_batch=3),
            str(tmp_path / "out"), str(tmp_path / "ck"), AVAILABLE_NOW,
        )
        query.awaitTermination()
        deadline = time.time() + 20
        while listener.totals.get(str(query.id), 0) < 40 and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals[str(query.id)] == 40
    assert "40 rows so far" in caplog.text


def test_totals_hold_over_batches_and_restarts(spark, tmp_path):
    """More batches than Spark remembers, in two runs; a repeated batch counts once."""
    topic, out = str(tmp_path / "t"), str(tmp_path / "out")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for _ in range(2):
            _json_topic(spark, topic, 40, files=4)
            stream_with_counts(
                stream_topic(spark, topic, files_per_batch=1),
                f"{out}/rows", f"{out}/counts", str(tmp_path / "ck"), AVAILABLE_NOW,
            ).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    found = running_totals(spark, f"{out}/counts").orderBy("batch").collect()
    assert [row.batch for row in found] == list(range(len(found)))
    assert len(found) == 8
    assert found[-1].total_rows == spark.read.parquet(f"{out}/rows").count() == 80
    for name in ("7", ".7.crc"):
        (tmp_path / "ck" / "commits" / name).unlink()
    stream_with_counts(
        stream_topic(spark, topic, files_per_batch=1),
        f"{out}/rows", f"{out}/counts", str(tmp_path / "ck"), AVAILABLE_NOW,
    ).awaitTermination()
    assert running_totals(spark, f"{out}/counts").agg({"total_rows": "max"}).first()[0] == 80
    assert spark.read.parquet(f"{out}/rows").count() == 80


def test_new_checkpoint_at_the_same_path_loses_nothing(spark, tmp_path):
    topic, root, checkpoint = str(tmp_path / "t"), str(tmp_path / "table"), tmp_path / "ck"
    decode = F.struct(F.col("value").cast("string").alias("text"))

    def run(files):
        topic_to_table(
            stream_topic(spark, topic, files_per_batch=files), decode, root, str(checkpoint),
            AVAILABLE_NOW,
        ).awaitTermination()

    _json_topic(spark, topic, 40, files=4)
    run(1)
    assert VersionedTable(spark, root).row_count() == 40
    remove_path(spark, str(checkpoint))
    _json_topic(spark, topic, 100, files=1)
    run(None)
    assert VersionedTable(spark, root).row_count() == 40 + 140


def test_floor_keeps_more_partitions(spark, tmp_path):
    topic = str(tmp_path / "t")
    _json_topic(spark, topic, 64, files=1)
    messages = read_topic(spark, topic)
    assert at_least_partitions(messages.repartition(64), 10).rdd.getNumPartitions() == 64
    assert at_least_partitions(messages.coalesce(1), 10).rdd.getNumPartitions() == 10
    with pytest.raises(ValueError, match="stream"):
        at_least_partitions(stream_topic(spark, topic), 10)


def test_what_is_no_json_has_a_folder_of_its_own(spark, tmp_path):
    topic, out = str(tmp_path / "t"), str(tmp_path / "out")
    values = ['{"a": 1}', '{"a":', None, "null", "[2]", "x"]
    sent = spark.createDataFrame([(v,) for v in values], "value string")
    write_topic(sent.select(F.col("value").cast("binary").alias("value")), topic, "things")
    topic_to_json_files(
        stream_topic(spark, topic), out, str(tmp_path / "ck"), trigger=AVAILABLE_NOW
    ).awaitTermination()
    found = spark.read.text(out).select("topic", "value")
    assert rows(found) == [
        ("things", "[2]"), ("things", '{"a": 1}'),
        ("things.rejects", "x"), ("things.rejects", '{"a":'),
    ]


def test_triggers_differ(spark, tmp_path):
    """When batches start: at once, at the interval's beat, or not before the minute is over."""

    def starts(trigger, files):
        topic, out = str(tmp_path / f"t{files}"), str(tmp_path / f"out{files}")
        _json_topic(spark, topic, 10, files=files)
        messages = stream_topic(spark, topic, files_per_batch=1)
        query = stream_to_parquet(messages, out, f"{out}-checkpoint", trigger)
        try:
            deadline = time.time() + 15
            while time.time() < deadline and len(_batches(query)) < files:
                time.sleep(0.2)
        finally:
            query.stop()
        return _batches(query)

    def _batches(query):
        done = [p for p in query.recentProgress if p.numInputRows]
        return [dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")) for p in done]

    # after a slow first batch the others catch the interval's beat
    beats = starts({"processingTime": "2 seconds"}, 5)
    assert beats[-1] - beats[-2] >= dt.timedelta(seconds=1.5)
    first, *others = starts({"processingTime": "1 minute"}, 2)
    assert all(other.second < 5 for other in others), first
    at_once = starts(None, 4)
    assert len(at_once) == 4
    assert min(b - a for a, b in zip(at_once, at_once[1:], strict=False)) < dt.timedelta(seconds=2)


def test_json_files_have_no_checksum_files_beside_them(spark, tmp_path):
    """The writer's options do not reach a stream's files; the session keeps its settings."""
    topic, target = str(tmp_path / "topic"), str(tmp_path / "files")
    write_topic(spark.range(40).select(F.to_json(F.struct("id")).alias("value")), topic, "t", partitions=2)
    topic_to_json_files(
        stream_topic(spark, topic), target, str(tmp_path / "checkpoint"), 5, AVAILABLE_NOW
    ).awaitTermination()
    assert spark.read.text(target).count() == 40
    assert list(tmp_path.glob("files/*/*/part-*"))
    assert not list(tmp_path.glob("files/*/*/.*.crc"))
    assert spark.conf.get("fs.file.impl", None) is None


def test_one_file_of_a_topic_is_read_by_several_tasks(spark, tmp_path):
    topic = str(tmp_path / "t")
    value = F.randstr(F.lit(1000), F.lit(1)).cast("binary").alias("value")
    write_topic(spark.range(0, 40000, 1, 1).select(value), topic, "t")
    messages = read_topic(spark, topic)
    assert len(messages.inputFiles()) == 1
    assert messages.select(F.spark_partition_id()).distinct().count() >= 4
    assert messages.select("offset").distinct().count() == 40000
