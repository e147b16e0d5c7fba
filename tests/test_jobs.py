"""The five jobs on rows of the taxi record."""

from __future__ import annotations

import json
import logging

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace import run
from millrace.operators.versioned import VersionedTable
from millrace.plans.jobs import (
    fill_topic,
    filter_csv,
    follow_topic,
    keep_trip_table,
    rewrite_partitions,
)
from millrace.schemas import TAXI, TAXI_RECORD
from millrace.sources.csv_files import read_csv, write_csv
from millrace.sources.topic import stream_topic
from millrace.streaming.sinks import AVAILABLE_NOW


@pytest.fixture
def trips(spark):
    n = F.col("id")
    values = {
        "VendorID": n % 3,
        "passenger_count": (n % 10).cast("double"),
        "trip_distance": (n % 7) / F.lit(2.0),
        "fare_amount": n.cast("double"),
        "PULocationID": n % 5,
    }
    columns = []
    for field in TAXI.fields:
        value = values.get(field.name, F.lit("1").cast(field.dataType))
        columns.append(value.cast(field.dataType).alias(field.name))
    return spark.range(0, 200, 1, 2).select(*columns)


def test_filter_csv_counts_and_copies(spark, tmp_path, trips):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    write_csv(trips, source)
    assert filter_csv(spark, source, target) == (200, 60)
    kept = read_csv(spark, target, TAXI)
    assert rows(kept) == rows(trips.where("passenger_count > 6"))


def test_trip_table(spark, tmp_path, trips):
    counts = keep_trip_table(spark, trips, str(tmp_path / "t"))
    expected = trips.where(
        "trip_distance <= 2.0 AND trip_distance > 0 "
        "AND CAST(fare_amount / NULLIF(trip_distance, 0) AS FLOAT) <= 4.0"
    )
    assert counts == (200, expected.count(), 200)
    table = VersionedTable(spark, str(tmp_path / "t"))
    names = table.schema.names
    assert names[8:12] == ["DOLocationID", "payment_type", "fare", "distance"] or (
        names[names.index("fare") :][:3] == ["fare", "distance", "fare_per_distance"]
    )
    assert table.partition_fields == ["VendorID"]
    assert table.read().where("fare_per_distance IS NOT NULL").count() == 0


@pytest.mark.parametrize("schema_id", [None, 7])
def test_fill_and_follow_topic(spark, tmp_path, trips, schema_id):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    fill_topic(trips, topic, "nyc", schema_id=schema_id)
    follow_topic(
        stream_topic(spark, topic), out, str(tmp_path / "ck"),
        has_header=schema_id is not None, trigger=AVAILABLE_NOW,
    ).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.schema == TAXI
    assert stored.exceptAll(trips).count() == trips.exceptAll(stored).count() == 0


def test_submitted_jobs(spark, tmp_path, trips, monkeypatch, caplog):
    caplog.set_level(logging.INFO, logger="millrace")
    source = str(tmp_path / "in")
    write_csv(trips, source)
    monkeypatch.setenv("INPUT_PATH", source)
    for job in run.TABLE_JOBS:
        run.run(spark, run.parse([job, "--output", str(tmp_path / job)]))
    assert "rows read: 200, rows kept: 60" in caplog.text
    assert "after rollback: 200" in caplog.text
    json_form, avro_form = ["--format", "json"], ["--schema-id", "3"]
    for form, stream_jobs in (
        (json_form, ["topic-to-json-files", "topic-to-table"]),
        (avro_form, ["follow-topic", "topic-to-parquet-files", "topic-to-table"]),
    ):
        topic = str(tmp_path / f"topic{form[1]}")
        run.run(spark, run.parse(["fill-topic", "--output", topic, "--topic", "trips", *form]))
        for job in stream_jobs:
            out = str(tmp_path / f"{job}{form[1]}")
            paths = ["--input", topic, "--output", out, "--checkpoint", f"{out}-ck"]
            run.run(spark, run.parse([job, "--trigger", "available-now", *paths, *form]))
            if job == "topic-to-table":
                stored = VersionedTable(spark, out).read()
            elif job == "topic-to-json-files":
                stored = spark.read.schema(TAXI).json(out)
            else:
                stored = spark.read.parquet(out)
            assert rows(stored.select(*TAXI.names)) == rows(trips), job
    paths = ["--input", "/i", "--output", "/o", "--checkpoint", "/c"]
    for wrong in (
        ["follow-topic", "--output", "/x"],
        ["fill-topic", "--input", "/i", "--output", "/o"],
        ["follow-topic", *paths, "--max-offsets", "5"],
        ["follow-topic", *paths, "--min-partitions", "5"],
        ["follow-topic", *paths, "--servers", "s:1", "--topic", "t", "--files-per-batch", "5"],
    ):
        with pytest.raises(SystemExit):
            run.parse(wrong)
    assert run.parse(["follow-topic", *paths, "--files-per-batch", "5"]).files_per_batch == 5


def test_bad_json_stops_no_stream(spark, tmp_path, trips):
    """Messages that do not parse go to a folder of their own, whole; the others go on."""
    topic = str(tmp_path / "t")
    run.write_topic(run.jobs.json_messages(trips), topic, "trips")
    bad = spark.createDataFrame([('{"VendorID": ',), ("[",), (None,)], "value string")
    run.write_topic(bad, topic, "trips")
    for job in ("follow-topic", "topic-to-parquet-files", "topic-to-table", "topic-to-rolled-json-files"):
        out = str(tmp_path / job)
        paths = ["--input", topic, "--output", out, "--checkpoint", f"{out}-ck", "--format", "json"]
        more = ["--max-messages", "90"] if job == "topic-to-table" else []
        run.run(spark, run.parse([job, "--trigger", "available-now", *paths, *more]))
        if job == "topic-to-rolled-json-files":
            waiting = spark.read.parquet(f"{out}.rest").groupBy("topic").count()
            assert rows(waiting) == [("trips", 200), ("trips.rejects", 2)]
            continue
        if job == "topic-to-table":
            table = VersionedTable(spark, out)
            stored = table.read()
            sizes = [int(row.summary["added-records"]) for row in table.snapshots().collect()]
            assert sorted(sizes) == [20, 90, 90]
        else:
            stored = spark.read.parquet(out).where("VendorID IS NOT NULL")
        assert rows(stored.select(*TAXI.names)) == rows(trips), job
        aside = spark.read.parquet(f"{out}.rejects")
        assert sorted(bytes(row["value"]) for row in aside.collect()) == [b"[", b'{"VendorID": ']


def test_messages_under_two_records(spark, tmp_path, trips):
    """One schema id from the options, another with a record file, fields in another order."""
    topic, out, file = str(tmp_path / "t"), str(tmp_path / "out"), tmp_path / "turned.json"
    turned = {**TAXI_RECORD, "fields": TAXI_RECORD["fields"][::-1]}
    file.write_text(json.dumps(turned))
    fill_topic(trips, topic, "trips", TAXI_RECORD, schema_id=3)
    fill_topic(trips.select(*TAXI.names[::-1]), topic, "trips", turned, schema_id=4)
    paths = ["--input", topic, "--output", out, "--checkpoint", f"{out}-ck"]
    ids = ["--schema-id", "3", "--schema", f"4={file}", "--trigger", "available-now"]
    run.run(spark, run.parse(["topic-to-parquet-files", *paths, *ids]))
    stored = spark.read.parquet(out).select(*TAXI.names)
    assert rows(stored) == rows(trips.unionByName(trips))


def test_rewrite_partitions(spark, tmp_path, trips):
    path = str(tmp_path / "t")
    rewrite_partitions(trips, path)
    assert len(list(tmp_path.glob("t/PULocationID=*"))) == 5
    assert rows(spark.read.schema(TAXI).parquet(path).select(*TAXI.names)) == rows(trips)
