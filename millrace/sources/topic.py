"""Message topics: the broker's envelope, and a folder of Parquet that stands in for a broker.

Every consumer in this library takes a DataFrame with the seven envelope columns, so
``kafka_stream`` and ``stream_topic`` are interchangeable. Writers likewise take
``value`` and an optional ``key``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.workspace import path_exists

ENVELOPE = (
    StructType()
    .add("key", "binary")
    .add("value", "binary")
    .add("topic", "string")
    .add("partition", "integer")
    .add("offset", "long")
    .add("timestamp", "timestamp")
    .add("timestampType", "integer")
)

# A task reads whole row groups. Of Parquet's usual size, 128 MB, a file is one or two, so that a batch
# of a few files is read and parsed by a few tasks, however many cores there are.
_ROW_GROUP_BYTES = 8 << 20


def _message(df: DataFrame) -> tuple[Column, Column]:
    key = F.col("key").cast("binary") if "key" in df.columns else F.lit(None).cast("binary")
    return key, F.col("value").cast("binary")


def write_topic(
    df: DataFrame,
    path: str,
    topic: str,
    partitions: int = 10,
    start_offset: int | None = None,
) -> None:
    """Append messages to a topic folder.

    A keyed message goes to the partition its key hashes to; messages without a key
    are dealt out in turn. Offsets are unique and grow from one write to the next, and
    have gaps, as a broker's offsets may. They come from ``monotonically_increasing_id``,
    so no partition of the topic is ever gathered in one task to be numbered, however
    hot its key. One producer writes at a time.

    ``start_offset`` must exceed every offset present; a producer that knows its
    position passes it, else the largest offset is looked up (a one-column scan).

    Files have many small row groups, so that all tasks share in reading a few files.
    """
    spark = df.sparkSession
    if start_offset is None:
        start_offset = next_offset(spark, path)
    key, value = _message(df)
    numbered = df.select(
        key.alias("key"), value.alias("value"), F.monotonically_increasing_id().alias("n")
    )
    keyed = F.pmod(F.xxhash64("key"), F.lit(partitions))
    in_turn = F.pmod(F.col("n"), F.lit(partitions))
    numbered.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.when(F.col("key").isNull(), in_turn).otherwise(keyed).cast("int").alias("partition"),
        (F.col("n") + F.lit(start_offset)).alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).write.mode("append").option("parquet.block.size", _ROW_GROUP_BYTES).parquet(path)


def next_offset(spark: SparkSession, path: str) -> int:
    """One more than the largest offset in a topic folder, 0 for a new one."""
    if not path_exists(spark, path):
        return 0
    last = read_topic(spark, path).agg(F.max("offset")).first()[0]
    return 0 if last is None else last + 1


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    """Replay a topic folder from the beginning."""
    return spark.read.schema(ENVELOPE).parquet(path)


def stream_topic(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Follow a topic folder from its earliest message, at most so many files or bytes per micro-batch.

    A file is never split between batches, so one file at least is taken in.
    """
    if files_per_batch is not None and bytes_per_batch is not None:
        raise ValueError("bound a batch by files or by bytes, not both")
    reader = spark.readStream.schema(ENVELOPE)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def at_least_partitions(messages: DataFrame, n: int) -> DataFrame:
    """The messages of a topic folder in ``n`` partitions or more; more stay as they are.

    Only for batch reads. A broker source is given ``min_partitions``, which splits
    offset ranges without moving data, and a stream over a folder takes
    ``files_per_batch`` and Spark's split size.
    """
    if messages.isStreaming:
        raise ValueError("a stream's partitions follow from its source's options")
    return messages if messages.rdd.getNumPartitions() >= n else messages.repartition(n)


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    min_partitions: int | None = None,
    max_offsets_per_batch: int | None = None,
) -> DataFrame:
    """Follow a broker topic from its earliest offset; needs Spark's Kafka package."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    if max_offsets_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_batch)
    return reader.load()


def kafka_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """All messages a broker topic holds now; needs Spark's Kafka package."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Send ``value`` (and ``key``, if present) to a broker topic; needs Spark's Kafka package."""
    key, value = _message(df)
    (
        df.select(key.alias("key"), value.alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
