from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators.partitions import (
    PartitionConflict,
    append_new_partitions,
    conflicting_partitions,
    read_partitioned,
    write_partitioned,
)


def _rows(spark, *values):
    return spark.createDataFrame(list(values), "n BIGINT, city STRING")


def test_one_directory_per_value(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(_rows(spark, (1, "A"), (2, "B"), (3, "B")), path, ["city"])
    assert sorted(p.name for p in tmp_path.glob("t/city=*")) == ["city=A", "city=B"]
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_partitioned(_rows(spark, (1, "A")), path, ["city"])


def test_overwrite_all_or_present(spark, tmp_path):
    for replace, left in (("all", [(9, "B")]), ("present", [(1, "A"), (9, "B")])):
        path = str(tmp_path / replace)
        write_partitioned(_rows(spark, (1, "A"), (2, "B")), path, ["city"])
        new = _rows(spark, (9, "B"))
        write_partitioned(new, path, ["city"], mode="overwrite", replace=replace)
        assert rows(read_partitioned(spark, path)) == left


def test_conflict_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    append_new_partitions(_rows(spark, (1, "A"), (2, "B")), path, ["city"])
    with pytest.raises(PartitionConflict, match="'city': 'B'"):
        append_new_partitions(_rows(spark, (3, "B"), (4, "C")), path, ["city"])
    assert rows(read_partitioned(spark, path)) == [(1, "A"), (2, "B")]
    append_new_partitions(_rows(spark, (4, "C")), path, ["city"])
    assert rows(read_partitioned(spark, path)) == [(1, "A"), (2, "B"), (4, "C")]


def test_conflict_of_null_and_number_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, None), (2, 5)], "n INT, zone BIGINT")
    append_new_partitions(old, path, ["zone"])
    new = spark.createDataFrame([(3, None), (4, 6)], "n INT, zone BIGINT")
    assert rows(conflicting_partitions(new, path, ["zone"])) == [(None,)]


def test_partition_values_that_look_like_numbers(spark, tmp_path):
    path = str(tmp_path / "t")
    df = _rows(spark, (1, "01"), (2, "1"), (3, "2024-01-01"))
    append_new_partitions(df, path, ["city"])
    with pytest.raises(PartitionConflict, match="'01'"):
        append_new_partitions(_rows(spark, (4, "01")), path, ["city"])
    append_new_partitions(_rows(spark, (4, "001")), path, ["city"])
    stored = read_partitioned(spark, path, df.schema)
    assert rows(stored) == [(1, "01"), (2, "1"), (3, "2024-01-01"), (4, "001")]


def test_conflict_check_opens_no_file(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(_rows(spark, (1, "A"), (2, "B")), path, ["city"])
    for file in tmp_path.glob("t/city=*/*"):
        file.write_bytes(b"no Parquet")
    new = _rows(spark, (3, "B"), (4, "C"))
    assert rows(conflicting_partitions(new, path, ["city"])) == [("B",)]


def test_append_to_a_folder_without_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    none = _rows(spark, (1, "A")).where("false")
    append_new_partitions(none, path, ["city"])
    append_new_partitions(_rows(spark, (1, "A")), path, ["city"])
    assert rows(read_partitioned(spark, path)) == [(1, "A")]


def test_filter_on_partition_column_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(_rows(spark, (1, "A"), (2, "B")), path, ["city"])
    plan = (
        read_partitioned(spark, path)
        .where("city = 'B'")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "PartitionFilters: [isnotnull(city" in plan


def test_hot_partition_is_split_over_tasks(spark, tmp_path):
    """A partition with nearly all rows must not go through one task."""
    path = str(tmp_path / "t")
    hot = spark.range(0, 400_000, 1, 8).select(
        F.xxhash64("id").alias("n"),
        F.when(F.col("id") < 390_000, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 20)).alias("city"),
    )
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    }
    for name, value in sizes.items():
        spark.conf.set(name, value)
    try:
        write_partitioned(hot, path, ["city"])
    finally:
        for name in sizes:
            spark.conf.unset(name)
    assert len(list(tmp_path.glob("t/city=hot/*.parquet"))) > 1
    assert len(list(tmp_path.glob("t/city=c1/*.parquet"))) == 1
    assert read_partitioned(spark, path).count() == 400_000


def test_sql_tables(spark, tmp_path):
    for _ in range(2):
        spark.sql("CREATE TABLE IF NOT EXISTS ports (code INT, harbour STRING)")
    assert spark.table("ports").dtypes == [("code", "int"), ("harbour", "string")]
    assert "default" in [row.namespace for row in spark.sql("SHOW DATABASES").collect()]
    location = tmp_path / "calls"

    def create():
        spark.sql(
            "CREATE TABLE IF NOT EXISTS calls (ship STRING, port STRING) "
            f"USING parquet PARTITIONED BY (port) LOCATION '{location}'"
        )

    def insert(ship):
        spark.sql(f"INSERT INTO calls PARTITION (port='KIEL') (ship) VALUES ('{ship}')")

    create()
    insert("Aurora")
    assert rows(spark.table("calls")) == [("Aurora", "KIEL")]
    spark.sql("DROP TABLE IF EXISTS calls")
    assert list(location.glob("port=KIEL/*.parquet"))
    create()
    assert rows(spark.table("calls")) == []
    insert("Borealis")
    assert rows(spark.table("calls")) == [("Aurora", "KIEL"), ("Borealis", "KIEL")]
    spark.sql("DROP TABLE calls")
    spark.sql("DROP TABLE ports")


def test_many_partitions_cost_little(spark, tmp_path):
    """No checksum file beside each file, and not a task to list each directory."""
    path = str(tmp_path / "t")
    df = spark.range(0, 1200, 1, 4).select("id", (F.col("id") % 400).alias("k"))
    write_partitioned(df, path, ["k"])
    assert len(list(tmp_path.glob("t/k=*/*.parquet"))) == 400
    assert not list(tmp_path.glob("t/k=*/.*.crc"))
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    usual, context = spark.conf.get(name), spark.sparkContext
    context.setJobGroup("listing of many", "")
    try:
        stored = read_partitioned(spark, path)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    jobs = [status.getJobInfo(n) for n in status.getJobIdsForGroup("listing of many")]
    tasks = [status.getStageInfo(n).numTasks for job in jobs for n in job.stageIds]
    assert tasks and max(tasks) <= 64
    assert spark.conf.get(name) == usual
    assert rows(stored) == rows(df.withColumn("k", F.col("k").cast("int")))
