from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

import __spark_entry__ as entry
from conftest import rows
from millrace import workspace
from millrace.sources.csv_files import (
    read_csv,
    read_csv_inferred,
    register_path,
    stream_csv,
    write_csv,
)
from millrace.sources.listing import folder_summary, list_objects, listing_summary
from millrace.sources.topic import kafka_batch, kafka_stream, write_kafka
from millrace.streaming.sinks import AVAILABLE_NOW, stream_to_parquet

AB = StructType().add("a", LongType()).add("b", StringType())


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_bad_or_empty_cell_is_null(spark, tmp_path):
    path = _write(tmp_path / "t.csv", "a,b\n1,x\nfoo,y\n,z\n")
    assert rows(read_csv(spark, path, AB)) == rows(
        spark.createDataFrame([(1, "x"), (None, "y"), (None, "z")], AB)
    )


def test_inferred_types_are_adjusted(spark, tmp_path):
    path = _write(tmp_path / "t.csv", "a,b\n1,x\n2,y\n")
    assert dict(read_csv_inferred(spark, path).dtypes)["a"] == "int"
    assert read_csv_inferred(spark, path, {"a": "bigint"}).schema == AB


def test_csv_keeps_nulls_empty_strings_quotes_and_micros(spark, tmp_path):
    df = spark.sql(
        "SELECT * FROM VALUES (1, '', TIMESTAMP_NTZ'2024-01-01 00:00:00.000001'), "
        "(2, NULL, NULL), (3, 'say \"a, b\"', TIMESTAMP_NTZ'2024-06-01 12:00:00') v(a, b, t)"
    )
    path = str(tmp_path / "out")
    write_csv(df, path, nullValue="\\N")
    assert rows(read_csv(spark, path, df.schema, nullValue="\\N")) == rows(df)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_csv(df, path)


def test_path_as_table(spark, tmp_path):
    path = _write(tmp_path / "t.csv", "a,b\n1,x\n8,y\n")
    register_path(spark, "named_path", path, AB)
    assert rows(spark.sql("SELECT b FROM named_path WHERE a > 6")) == [("y",)]


def test_filter_drops_null(spark):
    df = spark.sql("SELECT * FROM VALUES (7D), (6D), (NULL) v(passenger_count)")
    assert rows(df.where(F.col("passenger_count") > 6)) == [(7.0,)]


def test_csv_in_chunks(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    write_csv(spark.range(100).select(F.col("id").alias("a"), F.lit("x").alias("b")), source,
              maxRecordsPerFile="5")
    query = stream_to_parquet(
        stream_csv(spark, source, AB, files_per_batch=4), target, str(tmp_path / "ck"), AVAILABLE_NOW
    )
    query.awaitTermination()
    assert max(p["numInputRows"] for p in query.recentProgress) <= 20
    assert spark.read.parquet(target).select("a").distinct().count() == 100


def test_listing(spark, tmp_path):
    path = str(tmp_path / "out")
    spark.range(0, 10, 1, 3).write.parquet(path)
    summary = listing_summary(spark, path, "*.parquet").first()
    assert summary.objects == 3
    assert summary.total_bytes == sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet"))
    plan = list_objects(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_listing_by_folder(spark, tmp_path):
    """A folder with several files is one row; files on top are in a folder too."""
    path = str(tmp_path / "out")
    numbers = spark.range(0, 20, 1, 4).withColumn("part", F.col("id") % 2)
    numbers.write.partitionBy("part").parquet(path)
    found = {row.folder.split("/")[-1]: row for row in folder_summary(spark, path, "*.parquet").collect()}
    assert {name: row.objects for name, row in found.items()} == {"part=0": 4, "part=1": 4}
    for name, row in found.items():
        assert row.total_bytes == sum(f.stat().st_size for f in (tmp_path / "out" / name).glob("*.parquet"))


@pytest.mark.parametrize(("name", "column"), [("listing", "l_linenumber"), ("files_count", "l_returnflag")])
def test_counts_by_partition_whatever_the_number_of_files(spark, name, column):
    folder = "/root/testdata/sf0.001"
    wanted = spark.read.parquet(f"{folder}/lineitem.parquet").select(column).distinct().count()
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 300)
    try:
        assert entry.queries()[name](spark, folder).first()[0] == wanted
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_env_path(monkeypatch):
    assert workspace.path_from_env("NO_SUCH_PATH", "/a") == "/a"
    monkeypatch.setenv("INPUT_PATH", "/b")
    assert workspace.path_from_env("INPUT_PATH", "/a") == "/b"


def test_shared_root_comes_from_the_session(spark):
    assert workspace.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_broker_needs_its_connector(spark):
    messages = spark.sql("SELECT CAST('a' AS BINARY) AS value")
    for use in (
        lambda: kafka_stream(spark, "broker:9092", "t", min_partitions=10),
        lambda: kafka_batch(spark, "broker:9092", "t"),
        lambda: write_kafka(messages, "broker:9092", "t"),
    ):
        with pytest.raises(AnalysisException, match="(?i)kafka"):
            use()
