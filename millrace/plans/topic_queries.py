"""Topics: messages as JSON or Avro, batch and streaming consumers, sinks."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.avro import from_avro, from_framed_avro, to_avro
from millrace.functions.messages import (
    CORRUPT,
    frame_schema_id,
    framed,
    from_json_payload,
    json_payload,
    parse_json_payloads,
    unframed,
)
from millrace.functions.scalar import is_true
from millrace.functions.schemaless import json_objects, object_columns
from millrace.operators.versioned import VersionedTable
from millrace.plans.jobs import fill_topic, follow_topic
from millrace.plans.registry import query, table
from millrace.schemas import avro_record
from millrace.sources.topic import at_least_partitions, read_topic, stream_topic, write_topic
from millrace.streaming.progress import running_totals
from millrace.streaming.rolling import close_rolled_files, topic_to_rolled_json_files
from millrace.streaming.sinks import (
    AVAILABLE_NOW,
    drop_tombstones,
    stream_to_parquet,
    stream_with_counts,
    topic_table_path,
    topic_to_json_files,
    topic_to_parquet_files,
    topic_to_table,
)
from millrace.workspace import fresh_dir, remove_path

_FIELDS = [
    ("event_id", "long"),
    ("ts", "string"),
    ("user_id", "long"),
    ("event_type", "string"),
    ("value", "double"),
    ("props", "string"),
]
_RECORD_1 = avro_record("event", [f for f in _FIELDS if f[0] != "props"])
_RECORD_2 = avro_record("event", _FIELDS, nullable=("props",))
_RECORD = avro_record("event", _FIELDS)
_SCHEMA = (
    StructType()
    .add("event_id", "long")
    .add("ts", "timestamp_ntz")
    .add("user_id", "long")
    .add("event_type", "string")
    .add("value", "double")
    .add("props", "string")
)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _early() -> Column:
    """Clicks and views; an event without a type is neither."""
    return is_true(F.col("event_type").isin("click", "view"))


def _texts(rows: DataFrame) -> DataFrame:
    """Events with the time as text, as messages carry it."""
    return rows.withColumn("ts", F.col("ts").cast("string"))


def _typed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _json_messages(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("user_id").cast("string").alias("key"), json_payload().alias("value"))


def _json_topic(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "json-topic")
    write_topic(_json_messages(_events(spark, sf_dir)), path, "events")
    return path


def _parsed(messages: DataFrame) -> DataFrame:
    data = from_json_payload("value", _SCHEMA, mode="FAILFAST").alias("data")
    return messages.select(data).select("data.*")


def _run(spark: SparkSession, rows: DataFrame, target: str) -> DataFrame:
    query = stream_to_parquet(rows, target, f"{target}-checkpoint", AVAILABLE_NOW)
    query.awaitTermination()
    return spark.read.parquet(target)


@query("SELECT * FROM events")
def topic_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(read_topic(spark, _json_topic(spark, sf_dir)))


@query(
    "SELECT 'events' AS topic, COUNT(*) AS messages, COUNT(*) AS offsets, "
    "COUNT(DISTINCT user_id) AS keys FROM events"
)
def topic_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message has an offset of its own, and a key lies in one partition only."""
    messages = read_topic(spark, _json_topic(spark, sf_dir))
    by_place = messages.groupBy("topic", "partition", "key").agg(
        F.count("*").alias("messages"), F.count_distinct("offset").alias("offsets")
    )
    return by_place.groupBy("topic").agg(
        F.sum("messages").alias("messages"),
        F.sum("offsets").alias("offsets"),
        F.count("*").alias("keys"),
    )


@query("SELECT * FROM events")
def stream_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = stream_topic(spark, _json_topic(spark, sf_dir))
    return _run(spark, _parsed(messages), fresh_dir(spark, "stream"))


@query("SELECT * FROM events")
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run, stop, add messages, run again, and once more with nothing new."""
    topic, target = fresh_dir(spark, "json-topic"), fresh_dir(spark, "stream")
    early = _early()
    events = _events(spark, sf_dir)
    write_topic(_json_messages(events.where(early)), topic, "events")
    _run(spark, _parsed(stream_topic(spark, topic)), target)
    write_topic(_json_messages(events.where(~early)), topic, "events")
    _run(spark, _parsed(stream_topic(spark, topic)), target)
    return _run(spark, _parsed(stream_topic(spark, topic)), target)


@query("SELECT * FROM events")
def topic_min_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(at_least_partitions(read_topic(spark, _json_topic(spark, sf_dir)), 10))


def _faulty_topic(spark: SparkSession, sf_dir: str) -> str:
    """Messages of error events are cut off, those of signups have no value."""
    path = fresh_dir(spark, "faulty-topic")
    cut = F.concat(F.lit('{"event_id":'), F.col("event_id")).cast("binary")
    value = F.when(F.col("event_type") == "error", cut).when(
        F.col("event_type") != "signup", json_payload()
    )
    write_topic(_events(spark, sf_dir).select(value.alias("value")), path, "events")
    return path


@query("SELECT '{\"event_id\":' || event_id AS raw FROM events WHERE event_type = 'error'")
def topic_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = drop_tombstones(read_topic(spark, _faulty_topic(spark, sf_dir)))
    rows = parse_json_payloads(messages, _SCHEMA)
    return rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw"))


@query("SELECT * FROM events WHERE event_type NOT IN ('error', 'signup')")
def topic_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = drop_tombstones(stream_topic(spark, _faulty_topic(spark, sf_dir)))
    rows = parse_json_payloads(messages, _SCHEMA)
    return _run(spark, rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), fresh_dir(spark, "good"))


@query(
    "SELECT COUNT(CASE WHEN event_type = 'signup' THEN 1 END) AS tombstones, "
    "COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS malformed, "
    "COUNT(CASE WHEN event_type NOT IN ('error', 'signup') THEN 1 END) AS good FROM events"
)
def topic_message_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = read_topic(spark, _faulty_topic(spark, sf_dir)).select(
        from_json_payload("value", _SCHEMA).alias("data")
    )
    corrupt = F.col(f"data.{CORRUPT}").isNotNull()
    return data.agg(
        F.count_if(F.col("data").isNull()).alias("tombstones"),
        F.count_if(corrupt).alias("malformed"),
        F.count_if(F.col("data").isNotNull() & ~corrupt).alias("good"),
    )


@query("SELECT * FROM events")
def topic_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fresh_dir(spark, "json-files")
    messages = stream_topic(spark, _json_topic(spark, sf_dir))
    topic_to_json_files(
        messages, target, f"{target}-checkpoint", trigger=AVAILABLE_NOW
    ).awaitTermination()
    return _parsed(spark.read.text(target))


@query("SELECT * FROM events")
def topic_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = fresh_dir(spark, "warehouse")
    root = topic_table_path(warehouse, "shop", "raw.", "events")
    messages = stream_topic(spark, _json_topic(spark, sf_dir), files_per_batch=1)
    decode = from_json_payload("value", _SCHEMA, mode="FAILFAST")
    topic_to_table(
        messages, decode, root, f"{warehouse}/checkpoint", AVAILABLE_NOW
    ).awaitTermination()
    return VersionedTable(spark, root).read()


@query(
    "SELECT * FROM events UNION ALL "
    "SELECT * FROM events WHERE event_type IN ('click', 'view')"
)
def topic_table_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose checkpoint is lost starts over: old messages again, and all new ones."""
    topic, warehouse = fresh_dir(spark, "json-topic"), fresh_dir(spark, "warehouse")
    root = topic_table_path(warehouse, "shop", "raw.", "events")
    events, decode = _events(spark, sf_dir), from_json_payload("value", _SCHEMA, mode="FAILFAST")
    checkpoint = f"{warehouse}/checkpoint"
    for part, files in ((_early(), 1), (~_early(), None)):
        write_topic(_json_messages(events.where(part)), topic, "events")
        messages = stream_topic(spark, topic, files_per_batch=files)
        topic_to_table(messages, decode, root, checkpoint, AVAILABLE_NOW).awaitTermination()
        remove_path(spark, checkpoint)
    return VersionedTable(spark, root).read()


@query("SELECT * FROM events")
def topic_table_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, but each message once, in snapshots of a bounded size the second time."""
    topic, warehouse = fresh_dir(spark, "json-topic"), fresh_dir(spark, "warehouse")
    root = topic_table_path(warehouse, "shop", "raw.", "events")
    events, decode = _events(spark, sf_dir), from_json_payload("value", _SCHEMA, mode="FAILFAST")
    checkpoint = f"{warehouse}/checkpoint"
    for part, files, most in ((_early(), 1, None), (~_early(), None, 20_000)):
        write_topic(_json_messages(events.where(part)), topic, "events")
        topic_to_table(
            stream_topic(spark, topic, files_per_batch=files),
            decode,
            root,
            checkpoint,
            AVAILABLE_NOW,
            max_messages=most,
            once=True,
        ).awaitTermination()
        remove_path(spark, checkpoint)
    return VersionedTable(spark, root).read().drop("_topic", "_partition", "_offset")


@query(
    "SELECT '{\"event_id\":' || event_id AS raw FROM events WHERE event_type = 'error'"
)
def topic_json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fresh_dir(spark, "json-files")
    messages = stream_topic(spark, _faulty_topic(spark, sf_dir))
    topic_to_json_files(
        messages, target, f"{target}-checkpoint", trigger=AVAILABLE_NOW
    ).awaitTermination()
    lines = spark.read.text(target).where(F.col("topic") == "events.rejects")
    return lines.select(F.col("value").alias("raw"))


@query("SELECT COUNT(*) AS messages, 0 AS large_files FROM events")
def topic_rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No file has more records than asked for."""
    target = fresh_dir(spark, "json-files")
    messages = stream_topic(spark, _json_topic(spark, sf_dir))
    topic_to_json_files(
        messages, target, f"{target}-checkpoint", records_per_file=50, trigger=AVAILABLE_NOW
    ).awaitTermination()
    files = spark.read.text(target).groupBy(F.input_file_name().alias("file")).count()
    return files.agg(
        F.sum("count").alias("messages"),
        F.count_if(F.col("count") > 50).cast("int").alias("large_files"),
    )


@query("SELECT * FROM events")
def topic_schemaless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages read back without a given schema; times come as text."""
    objects = json_objects(read_topic(spark, _json_topic(spark, sf_dir)))
    return _typed(object_columns(objects))


@query(
    "SELECT * REPLACE (CASE WHEN event_type IN ('click', 'view') THEN NULL "
    "ELSE props END AS props) FROM events"
)
def stream_schemaless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream lands JSON as it is; a producer adds a field, and readers find it later."""
    topic, target = fresh_dir(spark, "json-topic"), fresh_dir(spark, "objects")
    events, early = _events(spark, sf_dir), _early()
    for part in (events.where(early).drop("props"), events.where(~early)):
        write_topic(_json_messages(part), topic, "events")
        _run(spark, json_objects(stream_topic(spark, topic)).select("body"), target)
    return _typed(object_columns(spark.read.parquet(target)))


@query(
    "SELECT COUNT(*) AS messages, COUNT(DISTINCT event_id) AS events, "
    "CEIL(COUNT(*) / 4000.0)::BIGINT AS snapshots, 0 AS large_snapshots FROM events"
)
def topic_table_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch in snapshots of at most four thousand messages, and once more for nothing."""
    warehouse = fresh_dir(spark, "warehouse")
    root = topic_table_path(warehouse, "shop", "raw.", "events")
    topic = _json_topic(spark, sf_dir)
    decode = from_json_payload("value", _SCHEMA, mode="FAILFAST")
    for _ in range(2):
        topic_to_table(
            stream_topic(spark, topic, bytes_per_batch=1 << 30),
            decode,
            root,
            f"{warehouse}/checkpoint",
            AVAILABLE_NOW,
            max_messages=4000,
        ).awaitTermination()
    made = VersionedTable(spark, root)
    added = F.col("summary")["added-records"].cast("long")
    sizes = made.snapshots().agg(
        F.count("*").alias("snapshots"), F.count_if(added > 4000).cast("int").alias("large_snapshots")
    )
    counts = made.read().agg(
        F.count("*").alias("messages"), F.count_distinct("event_id").alias("events")
    )
    return counts.crossJoin(sizes)  # one row each


@query("SELECT *, TRUE AS in_full_file FROM events")
def topic_rolled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs; every file but the last one of a topic partition has 250 records."""
    topic, target = fresh_dir(spark, "json-topic"), fresh_dir(spark, "rolled")
    events = _events(spark, sf_dir)
    for part in range(3):
        share = F.pmod(F.xxhash64("event_id"), F.lit(3)) == part
        write_topic(_json_messages(events.where(share)), topic, "events", partitions=2)
        topic_to_rolled_json_files(
            stream_topic(spark, topic, files_per_batch=4),
            f"{target}/files",
            f"{target}/rest",
            f"{target}/checkpoint",
            250,
            trigger=AVAILABLE_NOW,
        ).awaitTermination()
    close_rolled_files(spark, f"{target}/files", f"{target}/rest", 250)
    lines = spark.read.text(f"{target}/files/*/*", recursiveFileLookup="true")
    lines = lines.withColumn("file", F.input_file_name())
    short = lines.groupBy("file").count().where("count <> 250").agg(F.count("*").alias("short_files"))
    rows = lines.select(from_json_payload("value", _SCHEMA, mode="FAILFAST").alias("data"))
    return rows.crossJoin(short).select("data.*", (F.col("short_files") <= 2).alias("in_full_file"))


def _until_stopped(
    spark: SparkSession, sf_dir: str, trigger: dict[str, str | bool] | None
) -> DataFrame:
    """A stream that runs until another thread stops it, once it has taken in all messages."""
    target = fresh_dir(spark, "stream")
    rows = _parsed(stream_topic(spark, _json_topic(spark, sf_dir)))
    running = stream_to_parquet(rows, target, f"{target}-checkpoint", trigger)

    def stop() -> None:
        running.processAllAvailable()
        running.stop()

    with ThreadPoolExecutor(1) as other:
        stopped = other.submit(stop)
        running.awaitTermination()
        stopped.result()
    return spark.read.schema(_SCHEMA).parquet(target)


@query("SELECT * FROM events")
def stream_default_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _until_stopped(spark, sf_dir, None)


@query("SELECT * FROM events")
def stream_second_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _until_stopped(spark, sf_dir, {"processingTime": "1 second"})


@query("SELECT * FROM events")
def stream_minute_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first batch starts at once, the next would a minute later."""
    return _until_stopped(spark, sf_dir, {"processingTime": "1 minute"})


@query("SELECT COUNT(*) AS total_rows FROM events")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of one stream; the total holds over restarts."""
    topic, target = fresh_dir(spark, "json-topic"), fresh_dir(spark, "stream")
    events = _events(spark, sf_dir)
    for part in range(3):
        share = F.pmod(F.xxhash64("event_id"), F.lit(3)) == part
        write_topic(_json_messages(events.where(share)), topic, "events")
        stream_with_counts(
            _parsed(stream_topic(spark, topic, files_per_batch=4)),
            f"{target}/rows",
            f"{target}/counts",
            f"{target}/checkpoint",
            AVAILABLE_NOW,
        ).awaitTermination()
    totals = running_totals(spark, f"{target}/counts")
    return totals.agg(F.max("total_rows").alias("total_rows"))


# ------------------------------------------------------------------ Avro


@query("SELECT * FROM events")
def avro_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = _texts(_events(spark, sf_dir)).select(
        to_avro(F.struct("*"), _RECORD).alias("value")
    )
    return _typed(packed.select(from_avro("value", _RECORD).alias("data")).select("data.*"))


@query("SELECT * FROM events")
def topic_follow_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to a topic of framed Avro messages, and from there to Parquet as a stream."""
    topic, target = fresh_dir(spark, "avro-topic"), fresh_dir(spark, "stream")
    fill_topic(_texts(_events(spark, sf_dir)), topic, "events", _RECORD, schema_id=1)
    messages = stream_topic(spark, topic)
    follow_topic(
        messages, target, f"{target}-checkpoint", _RECORD, trigger=AVAILABLE_NOW
    ).awaitTermination()
    return _typed(spark.read.parquet(target))


def _two_schema_topic(spark: SparkSession, sf_dir: str) -> str:
    """Clicks and views are written before the record got its last field."""
    topic = fresh_dir(spark, "avro-topic")
    rows = _texts(_events(spark, sf_dir))
    early = _early()
    for part, record, schema_id in (
        (rows.where(early).drop("props"), _RECORD_1, 1),
        (rows.where(~early), _RECORD_2, 2),
    ):
        fill_topic(part, topic, "events", record, schema_id)
    return topic


@query(
    "SELECT * REPLACE (CASE WHEN event_type IN ('click', 'view') THEN NULL "
    "ELSE props END AS props) FROM events"
)
def avro_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read_topic(spark, _two_schema_topic(spark, sf_dir))
    decode = from_framed_avro("value", {1: _RECORD_1, 2: _RECORD_2}, _RECORD_2)
    return _typed(messages.select(decode.alias("data")).select("data.*"))


@query(
    "SELECT CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 2 END AS schema_id, "
    "COUNT(*) AS messages FROM events GROUP BY 1"
)
def avro_schema_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read_topic(spark, _two_schema_topic(spark, sf_dir))
    return messages.groupBy(frame_schema_id("value").alias("schema_id")).agg(
        F.count("*").alias("messages")
    )


@query(
    "SELECT * REPLACE (CASE WHEN event_type IN ('click', 'view') THEN NULL "
    "ELSE props END AS props) FROM events"
)
def topic_avro_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fresh_dir(spark, "avro-files")
    messages = stream_topic(spark, _two_schema_topic(spark, sf_dir))
    decode = from_framed_avro("value", {1: _RECORD_1, 2: _RECORD_2}, _RECORD_2)
    topic_to_parquet_files(
        messages, decode, target, f"{target}-checkpoint", trigger=AVAILABLE_NOW
    ).awaitTermination()
    return _typed(spark.read.parquet(target).drop("topic", "partition"))


@query(
    "SELECT * REPLACE (CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value) "
    "FROM (SELECT event_id, event_type, value FROM events)"
)
def avro_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of error events are cut off; they decode to NULL and the rest stays whole."""
    packed: Column = to_avro(F.struct("*"), _RECORD)
    rows = _texts(_events(spark, sf_dir))
    sent = rows.select("event_id", "event_type", packed.alias("value"))
    cut = F.when(F.col("event_type") == "error", F.substring("value", 1, 9))
    damaged = sent.withColumn("value", F.coalesce(cut, "value"))
    data = from_avro(unframed(framed(F.col("value"), 1)), _RECORD, mode="PERMISSIVE")
    return damaged.select("event_id", "event_type", data.alias("data")).select(
        "event_id", "event_type", F.col("data.value").alias("value")
    )
