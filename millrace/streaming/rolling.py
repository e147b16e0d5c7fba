"""Files of an exact number of records from small micro-batches."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.numbering import by_whole_chunks, in_chunks
from millrace.streaming.sinks import QUERY_ID, Trigger, json_lines, start
from millrace.workspace import BARE_FILES, path_exists, remove_path, scratch, staged

_PLACE = ("topic", "partition")
_ROWS = "topic string, partition int, offset bigint, value string, since timestamp"


def topic_to_rolled_json_files(
    messages: DataFrame,
    path: str,
    rest: str,
    checkpoint: str,
    records_per_file: int = 1000,
    max_wait: timedelta | None = None,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Write JSON messages as lines, each file with exactly so many records of a topic partition.

    What does not fill a file waits in the folder ``rest`` for later batches and restarts;
    ``close_rolled_files`` writes it out in the end. With ``max_wait`` a batch also writes out
    what has waited that long. Files are below ``path``, by stream and batch, then topic and
    partition; a batch that is run again replaces its own files and its own rest, so that each
    message is in one file once. Messages are chosen and routed as ``topic_to_json_files`` does.

    Rows are numbered over all tasks, so that a hot topic partition is many tasks' work; what
    waits is less than a file per topic partition.
    """
    lines = json_lines(messages, "offset").withColumn("since", F.current_timestamp())

    def roll(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query_id = session.sparkContext.getLocalProperty(QUERY_ID)
        kept = f"{rest}/stream={query_id}"
        waiting = f"{kept}/batch={number - 1}"
        with scratch(session):
            rows = batch.select("topic", "partition", "offset", "value", "since")
            if path_exists(session, waiting):
                rows = rows.unionByName(session.read.schema(_ROWS).parquet(waiting))
            chunks = staged(in_chunks(rows, records_per_file, _PLACE, ("offset",)), "rolling")
            ready = _ready(chunks, records_per_file, max_wait)
            _write(ready.where("ready"), f"{path}/stream={query_id}/batch={number}", records_per_file)
            left = ready.where("NOT ready").select("topic", "partition", "offset", "value", "since")
            left.write.mode("overwrite").parquet(f"{kept}/batch={number}")
        # the batch before this one can run again no more, so what it read is not needed
        remove_path(session, f"{kept}/batch={number - 2}")

    return start(lines.writeStream.foreachBatch(roll), checkpoint, trigger)


def _ready(chunks: DataFrame, records_per_file: int, max_wait: timedelta | None) -> DataFrame:
    """Adds whether a row's chunk is full or has waited long enough; one small row per chunk decides."""
    sizes = chunks.groupBy(*_PLACE, "chunk").agg(
        F.count("*").alias("records"), F.min("since").alias("oldest")
    )
    full: Column = F.col("records") >= records_per_file
    if max_wait is not None:
        full |= F.col("oldest") <= F.current_timestamp() - F.lit(max_wait)
    short = sizes.where(~full).select(*_PLACE, "chunk", F.lit(False).alias("is_ready"))
    marked = chunks.join(staged(short, "short"), [*_PLACE, "chunk"], "left")
    return marked.withColumn("ready", F.coalesce("is_ready", F.lit(True)))


def _write(chunks: DataFrame, path: str, records_per_file: int) -> None:
    whole = by_whole_chunks(chunks, _PLACE).select(*_PLACE, "value")
    writer = whole.write.mode("overwrite").partitionBy(*_PLACE).options(**BARE_FILES)
    writer.option("maxRecordsPerFile", records_per_file).text(path)


def close_rolled_files(
    spark: SparkSession, path: str, rest: str, records_per_file: int = 1000
) -> None:
    """Write out what still waits, a short file per topic partition; the stream must have stopped.

    Run again after a failure it replaces its own files. A stream started later on the same
    checkpoint begins without a rest.
    """
    if not path_exists(spark, rest):
        return
    waiting = spark.read.schema(f"{_ROWS}, stream string, batch bigint").parquet(rest)
    for row in waiting.groupBy("stream").agg(F.max("batch").alias("batch")).collect():
        rows = spark.read.schema(_ROWS).parquet(f"{rest}/stream={row['stream']}/batch={row['batch']}")
        with scratch(spark):
            chunks = in_chunks(rows, records_per_file, _PLACE, ("offset",))
            _write(chunks, f"{path}/stream={row['stream']}/closed={row['batch']}", records_per_file)
        remove_path(spark, f"{rest}/stream={row['stream']}")
