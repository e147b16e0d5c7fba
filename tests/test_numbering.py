"""Row numbers and chunks against plain Python."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.numbering import by_whole_chunks, in_chunks, numbered
from millrace.sources.csv_files import (
    read_csv_chunks,
    stream_csv,
    stream_csv_chunk_lanes,
    stream_csv_chunks,
    write_csv,
    write_csv_lanes,
)
from millrace.streaming.progress import running_totals
from millrace.streaming.sinks import (
    AVAILABLE_NOW,
    lanes_to_parquet,
    read_lanes,
    stream_with_counts,
)

SCHEMA = "kind string, at long, task int, place string"


def odd_rows(count):
    rng = random.Random(count)
    kinds = ["hot"] * 6 + ["a", "b", None, ""]
    rows = [(rng.choice(kinds), at, rng.randrange(3), None) for at in range(count)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("count", [0, 1, 997])
@pytest.mark.parametrize("tasks", [1, 7])
def test_numbers_in_groups(spark, count, tasks):
    """Also with columns named like those used within, and with rows in no order."""
    rows = odd_rows(count)
    df = spark.createDataFrame(rows, SCHEMA).repartition(tasks)
    got = numbered(df, "nth", ["kind"], ["at"])
    assert got.columns == ["kind", "at", "task", "place", "nth"]
    seen, expected = Counter(), []
    for kind, at, task, place in sorted(rows, key=lambda row: row[1]):
        expected.append((kind, at, task, place, seen[kind]))
        seen[kind] += 1
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_numbers_in_read_order(spark):
    df = spark.range(0, 1000, 1, 7).select(F.col("id").alias("at"))
    got = numbered(df, "nth").collect()
    assert len(got) == 1000
    assert all(row["at"] == row["nth"] for row in got)


def test_numbers_repeat(spark):
    rows = spark.createDataFrame(odd_rows(300), SCHEMA)
    first, second = (
        sorted(map(tuple, numbered(rows.repartition(n), "nth", order=["at"]).collect()), key=repr)
        for n in (2, 5)
    )
    assert first == second


def test_refusals(spark):
    rows = spark.createDataFrame(odd_rows(3), SCHEMA)
    with pytest.raises(ValueError, match="order"):
        numbered(rows, "nth", ["kind"])
    with pytest.raises(ValueError, match="exists"):
        numbered(rows, "at")
    with pytest.raises(ValueError, match="at least one"):
        in_chunks(rows, 0)
    with pytest.raises(ValueError, match="already"):
        in_chunks(rows.withColumn("chunk", F.lit(1)), 5)


@pytest.mark.parametrize("size", [1, 10, 250, 251, 5000])
def test_one_file_for_each_chunk(spark, tmp_path, size):
    rows = spark.range(0, 250 * 3 + 20, 1, 5).select("id", (F.col("id") % 2).alias("side"))
    chunked = in_chunks(rows, size, ["side"], ["id"])
    target = f"{tmp_path}/out"
    writer = by_whole_chunks(chunked, ["side"]).write.partitionBy("side")
    writer.option("maxRecordsPerFile", size).parquet(target)
    files = defaultdict(list)
    read = spark.read.parquet(target).select(F.input_file_name().alias("file"), "side", "chunk", "id")
    for row in read.collect():
        files[row["file"]].append((row["side"], row["chunk"], row["id"]))
    assert all(len({found[:2] for found in rows}) == 1 for rows in files.values())
    sizes = defaultdict(list)
    for found in files.values():
        sizes[found[0][0]].append(len(found))
    for side in (0, 1):
        full, rest = divmod(385, size)
        assert sorted(sizes[side]) == sorted([size] * full + [rest] * bool(rest))


def test_csv_in_chunks(spark, tmp_path):
    rows = spark.range(0, 2345, 1, 3).select("id", F.lit("a, b").alias("text"))
    write_csv(rows, f"{tmp_path}/csv")
    got = read_csv_chunks(spark, f"{tmp_path}/csv", rows.schema, 1000)
    sizes = dict(map(tuple, got.groupBy("chunk").count().collect()))
    assert sizes == {0: 1000, 1: 1000, 2: 345}
    assert all(row["id"] == 1000 * row["chunk"] + row["chunk_row"] for row in got.collect())


def test_csv_batches(spark, tmp_path):
    rows = spark.range(0, 1050, 1, 4).select("id", F.lit("x").alias("text"))
    write_csv(rows, f"{tmp_path}/csv")
    stream = stream_csv_chunks(spark, f"{tmp_path}/csv", rows.schema, 300)
    stream_with_counts(
        stream, f"{tmp_path}/rows", f"{tmp_path}/counts", f"{tmp_path}/check", AVAILABLE_NOW
    ).awaitTermination()
    batches = running_totals(spark, f"{tmp_path}/counts").collect()
    assert sorted(row["rows"] for row in batches) == [150, 300, 300, 300]
    assert sorted(row["id"] for row in spark.read.parquet(f"{tmp_path}/rows").collect()) == list(range(1050))


def _file_sizes(spark, path, lanes, schema):
    """Rows of each file that each stream wrote."""
    rows = read_lanes(spark, path, schema, lanes)
    counts = rows.groupBy(F.input_file_name().alias("file")).count().collect()
    return sorted(row["count"] for row in counts)


@pytest.mark.parametrize("count", [0, 100, 1050])
def test_csv_batches_side_by_side(spark, tmp_path, count):
    """Chunks are whole in every lane, and all rows are there; few rows make few lanes."""
    rows = spark.range(0, count, 1, 4).select("id", F.lit("x").alias("lane"))
    write_csv(rows, f"{tmp_path}/csv")
    lanes = stream_csv_chunk_lanes(spark, f"{tmp_path}/csv", rows.schema, 300, lanes=3)
    lanes_to_parquet(lanes, f"{tmp_path}/rows", f"{tmp_path}/check", AVAILABLE_NOW)
    assert len(lanes) == min(3, -(-count // 300))
    wanted = [300] * (count // 300) + [count % 300] * bool(count % 300)
    assert _file_sizes(spark, f"{tmp_path}/rows", len(lanes), rows.schema) == sorted(wanted)
    found = read_lanes(spark, f"{tmp_path}/rows", rows.schema, len(lanes)).collect()
    assert sorted(map(tuple, found)) == [(n, "x") for n in range(count)]


def test_csv_files_dealt_to_lanes(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 4).select("id", F.lit("x").alias("text"))
    folders = write_csv_lanes(rows, f"{tmp_path}/csv", 30, 3)
    files = [list(Path(folder).glob("*.csv")) for folder in folders]
    assert [len(found) for found in files] == [12, 12, 12]
    assert max(len(file.read_text().splitlines()) - 1 for found in files for file in found) == 30
    lanes = [stream_csv(spark, folder, rows.schema, files_per_batch=10) for folder in folders]
    lanes_to_parquet(lanes, f"{tmp_path}/rows", f"{tmp_path}/check", AVAILABLE_NOW)
    found = read_lanes(spark, f"{tmp_path}/rows", rows.schema, 3).collect()
    assert sorted(row["id"] for row in found) == list(range(1000))
