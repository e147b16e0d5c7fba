"""The five whole jobs: filter a CSV, keep a table, fill and follow a topic, rewrite partitions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.functions.avro import from_avro, to_avro
from millrace.functions.messages import framed, json_payload, unframed
from millrace.functions.scalar import float_ratio
from millrace.operators.partitions import write_partitioned
from millrace.operators.versioned import VersionedTable
from millrace.schemas import TAXI, TAXI_RECORD
from millrace.sources.csv_files import read_csv, write_csv
from millrace.sources.topic import write_topic
from millrace.streaming.sinks import Trigger, stream_to_parquet


class RowCounts(NamedTuple):
    total: int
    kept: int


def filter_csv(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType = TAXI,
    condition: Column | None = None,
) -> RowCounts:
    """Copy the rows that meet the condition (by default more than six passengers) to CSV.

    The write job itself counts rows read and rows kept, so the source is scanned once.
    """
    keep = F.col("passenger_count") > 6 if condition is None else condition
    counts = Observation()
    rows = read_csv(spark, source, schema).observe(
        counts, F.count("*").alias("total"), F.count_if(keep).alias("kept")
    )
    write_csv(rows.where(keep), target)
    return RowCounts(counts.get["total"], counts.get["kept"])


class TableCounts(NamedTuple):
    created: int
    after_deletes: int
    after_rollback: int


def keep_trip_table(
    spark: SparkSession,
    rows: DataFrame,
    root: str,
    fare: str = "fare_amount",
    distance: str = "trip_distance",
    partition_field: str = "VendorID",
    max_ratio: float = 4.0,
    max_distance: float = 2.0,
    note: str | None = None,
) -> TableCounts:
    """Create a table, rename, note, move and add columns, fill one, delete, and roll back."""
    table = VersionedTable.create(spark, root, rows, mode="overwrite")
    created = table.row_count()
    first = table.current_snapshot_id
    table.rename_column(fare, "fare")
    table.rename_column(distance, "distance")
    if note is not None:
        table.comment_column("distance", note)
    table.move_column("distance", after="fare")
    table.add_column("fare_per_distance", "FLOAT", after="distance")
    table.update({"fare_per_distance": float_ratio("fare", "distance")})
    too_much = (F.col("fare_per_distance") > max_ratio) | (F.col("distance") > max_distance)
    table.delete(too_much)
    table.delete(F.col("fare_per_distance").isNull())
    after_deletes = table.row_count()
    table.add_partition_field(partition_field)
    table.rollback(first)
    return TableCounts(created, after_deletes, table.row_count())


def avro_messages(
    rows: DataFrame, record: dict = TAXI_RECORD, schema_id: int | None = None
) -> DataFrame:
    """Each row as one Avro ``value``, with a schema-id header if an id is given."""
    payload = to_avro(F.struct("*"), record)
    if schema_id is not None:
        payload = framed(payload, schema_id)
    return rows.select(payload.alias("value"))


def json_messages(rows: DataFrame) -> DataFrame:
    """Each row as one JSON ``value``, NULL fields as null."""
    return rows.select(json_payload().alias("value"))


def fill_topic(
    rows: DataFrame,
    path: str,
    topic: str,
    record: dict = TAXI_RECORD,
    schema_id: int | None = None,
) -> None:
    """Send each row as one Avro message to a topic folder."""
    write_topic(avro_messages(rows, record, schema_id), path, topic)


def follow_topic(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    record: dict = TAXI_RECORD,
    has_header: bool = True,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Append a topic's Avro messages to a Parquet folder, by default once a minute."""
    payload = unframed("value") if has_header else F.col("value")
    rows = messages.select(from_avro(payload, record).alias("data")).select("data.*")
    return stream_to_parquet(rows, path, checkpoint, trigger or {"processingTime": "1 minute"})


def rewrite_partitions(rows: DataFrame, path: str, by: str = "PULocationID") -> None:
    """Write a table in partitions, then again over it, as when all files are made anew."""
    write_partitioned(rows, path, [by])
    write_partitioned(rows, path, [by], mode="overwrite")
