"""Append streams into files and versioned tables.

Each function starts one query and returns it; ``awaitTermination`` blocks until it is
stopped. ``trigger`` is what ``DataStreamWriter.trigger`` takes, for example
``{"processingTime": "1 minute"}``; without one, batches follow each other at once. A
restart on the same checkpoint goes on where the last run stopped.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.numbering import free_names, in_chunks
from millrace.operators.versioned import VersionedTable
from millrace.workspace import bare_files, large_state, scratch, staged

Trigger = dict[str, str | bool]
# what Spark calls the id of the running query among the properties of its jobs
QUERY_ID = "sql.streaming.queryId"
# where a message stands
_PLACE = ("topic", "partition", "offset")
AVAILABLE_NOW: Trigger = {"availableNow": True}
# files that a run of offsets of one topic partition fills, where offsets have no gaps
_FILES_PER_STRETCH = 200


def drop_tombstones(messages: DataFrame) -> DataFrame:
    """Messages that have a value."""
    return messages.where(F.col("value").isNotNull())


def stream_to_parquet(
    rows: DataFrame, path: str, checkpoint: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """Append a stream of rows to a Parquet folder; what it holds as state may be large."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    with large_state(rows.sparkSession):
        return start(writer, checkpoint, trigger)


def lanes_to_parquet(
    lanes: Sequence[DataFrame], path: str, checkpoint: str, trigger: Trigger
) -> None:
    """Append streams to a folder each below ``path``, side by side, until all have ended.

    If one fails the others are stopped. ``read_lanes`` reads what they have written.
    """
    running: list[StreamingQuery] = []
    try:
        for number, rows in enumerate(lanes):
            place = f"lane={number}"
            running.append(stream_to_parquet(rows, f"{path}/{place}", f"{checkpoint}/{place}", trigger))
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:
            query.stop()


def read_lanes(spark: SparkSession, path: str, schema: StructType, lanes: int) -> DataFrame:
    """What so many streams of ``lanes_to_parquet`` wrote, of finished batches only."""
    found = spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
    for number in range(lanes):
        # a folder by itself is read by the list of files that its stream keeps
        found = found.union(spark.read.schema(schema).parquet(f"{path}/lane={number}"))
    return found


def json_lines(messages: DataFrame, *others: str) -> DataFrame:
    """Rows (topic, partition, others, value): one line of JSON for each message that is some.

    Messages without a value, and those whose value is the JSON word null, are left out. What
    is no JSON gets a topic of its own, named after its topic with ``.rejects`` behind.
    """
    # outside of strings, line breaks in JSON are mere spacing; inside they are escaped
    line = F.translate(F.col("value").cast("string"), "\r\n", "  ").alias("value")
    lines = drop_tombstones(messages).where(F.trim(line) != "null")
    is_json = F.try_parse_json(line).isNotNull()
    topic = F.when(is_json, F.col("topic")).otherwise(F.concat("topic", F.lit(".rejects")))
    return lines.select(topic.alias("topic"), "partition", *others, line)


def topic_to_json_files(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    records_per_file: int = 1000,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Write JSON messages as lines, in folders by topic and topic partition.

    Files may have fewer records; ``rolling`` has a sink that keeps them for the next batch.
    Stretches of offsets, each of many files, are dealt over the tasks: a batch is written by
    all of them however few files it is read from and however hot a topic partition, and a
    stretch leaves one short file per topic partition at most. Messages are chosen and routed by
    ``json_lines``.
    """
    stretch = F.expr(f"offset div {records_per_file * _FILES_PER_STRETCH}")
    spread = json_lines(messages, "offset").repartition("topic", "partition", stretch)
    writer = (
        spread.select("topic", "partition", "value")
        .writeStream.format("text")
        .outputMode("append")
        .partitionBy("topic", "partition")
        .option("maxRecordsPerFile", records_per_file)
        .option("path", path)
    )
    with bare_files(messages.sparkSession):
        return start(writer, checkpoint, trigger)


def topic_to_parquet_files(
    messages: DataFrame,
    decode: Column,
    path: str,
    checkpoint: str,
    records_per_file: int = 10000,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Decode messages to a struct and write its fields as Parquet, by topic and partition."""
    decoded = drop_tombstones(messages).select("topic", "partition", decode.alias("data"))
    writer = (
        decoded.select("topic", "partition", "data.*")
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("topic", "partition")
        .option("maxRecordsPerFile", records_per_file)
        .option("compression", "snappy")
        .option("path", path)
    )
    return start(writer, checkpoint, trigger)


def stream_with_counts(
    rows: DataFrame, path: str, counts: str, checkpoint: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet folder, and how many rows each batch had to another.

    Both are folders by query id and batch. A batch that is run again after a failure
    replaces its own, so the counts hold over restarts; see ``progress.running_totals``.
    """

    def append(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query_id = session.sparkContext.getLocalProperty(QUERY_ID)
        place = f"stream={query_id}/batch={number}"
        found = Observation()
        counted = batch.observe(found, F.count("*").alias("rows"))
        counted.write.mode("overwrite").parquet(f"{path}/{place}")
        row = session.range(1).select(F.lit(found.get["rows"]).cast("long").alias("rows"))
        row.write.mode("overwrite").parquet(f"{counts}/{place}")

    return start(rows.writeStream.foreachBatch(append), checkpoint, trigger)


def topic_table_path(warehouse: str, namespace: str, prefix: str, topic: str) -> str:
    """Where a topic's table lives: namespace, then prefix and topic in word characters."""
    return f"{warehouse.rstrip('/')}/{namespace}/{re.sub(r'[^A-Za-z0-9_]', '_', prefix + topic)}"


def topic_to_table(
    messages: DataFrame,
    decode: Column,
    root: str,
    checkpoint: str,
    trigger: Trigger | None = None,
    partition_by: tuple[str, ...] = (),
    max_messages: int | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Append decoded messages to a versioned table, one snapshot per micro-batch.

    The table is created from the message schema on first use. Each snapshot names its
    batch and the query's id, so a batch that is run again after a failure adds nothing. The
    id is new with every checkpoint: a stream that starts over, at the same path too,
    numbers its batches anew and adds all that they hold.

    With ``max_messages`` no snapshot has more: a larger batch is split by the order of topic,
    partition and offset, which is the same whenever it is run, into parts that are snapshots
    of their own and known by their number. The first two are committed alone, then as many at
    once as there are already: few jobs whatever the number of parts, and a batch that fails
    writes at most as many parts again as it had committed, or the first one. How much a batch takes in is up to
    the source, ``bytes_per_batch`` of ``stream_topic`` for one.

    With ``once`` the table also has each message's ``_topic``, ``_partition`` and ``_offset``, and a
    stream that starts over adds only messages that no earlier stream has added. It looks
    at these columns of what others wrote, within the batch's range of offsets; a stream
    alone with its table looks at nothing.
    """

    def append(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        given = drop_tombstones(batch)
        place = [F.col(name).alias(f"_{name}") for name in _PLACE] if once else []
        data = F.struct(decode.alias("data"), *place).alias("data")
        rows = given.select(data).select("data.data.*", *(f"data._{n}" for n in _PLACE if once))
        table = VersionedTable.create(
            session, root, rows.schema, partition_by=partition_by, mode="ignore"
        )
        query_id = session.sparkContext.getLocalProperty(QUERY_ID)
        if not query_id:
            raise RuntimeError("the batch does not tell which query it belongs to")
        if once and table.streams() - {query_id}:
            rows = _not_in_table(rows, table)
            given = given.join(
                rows.select(*(F.col(f"_{name}").alias(name) for name in _PLACE)), list(_PLACE), "left_semi"
            )
        if max_messages is None:
            table.append(rows, batch=(query_id, number))
            return
        with scratch(session):
            parts = in_chunks(given.select(*_PLACE, data), max_messages, order=_PLACE)
            parts = staged(parts.select("data", "chunk"), "batch-parts")
            last = parts.agg(F.max("chunk")).first()[0]
            (name,) = free_names(rows.columns, "part")
            first, end = 0, 1
            while last is not None and first <= last:
                found = parts.where(F.col("chunk").between(first, end - 1)).select(
                    "data.data.*", *(f"data._{n}" for n in _PLACE if once), F.col("chunk").alias(name)
                )
                table.append(found, batch=(query_id, number, name))
                first, end = end, 2 * end

    return start(messages.writeStream.foreachBatch(append), checkpoint, trigger)


def _not_in_table(rows: DataFrame, table: VersionedTable) -> DataFrame:
    """Rows with a place (topic, partition, offset) that the table does not have."""
    place = [f"_{name}" for name in _PLACE]
    ends = rows.agg(F.min("_offset").alias("low"), F.max("_offset").alias("high")).first()
    if ends.low is None:
        return rows
    there = table.read().where(F.col("_offset").between(ends.low, ends.high)).select(*place)
    return rows.join(there, place, "left_anti")


def start(
    writer: DataStreamWriter, checkpoint: str, trigger: Trigger | None
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
