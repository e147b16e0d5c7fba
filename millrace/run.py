"""Submit one of the jobs: ``spark-submit millrace/run.py <job> [options]``.

Paths come from options, else from the environment (INPUT_PATH, OUTPUT_PATH,
CHECKPOINT_PATH). Topics are folders unless ``--servers`` names brokers, which needs
Spark's Kafka package. Store credentials and endpoints belong in the Spark configuration.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.functions.avro import from_avro, from_framed_avro  # noqa: E402
from millrace.functions.messages import split_json_messages  # noqa: E402
from millrace.plans import jobs  # noqa: E402
from millrace.schemas import TAXI, TAXI_RECORD  # noqa: E402
from millrace.sources.csv_files import read_csv  # noqa: E402
from millrace.sources.topic import (  # noqa: E402
    kafka_stream,
    stream_topic,
    write_kafka,
    write_topic,
)
from millrace.streaming import sinks  # noqa: E402
from millrace.streaming.progress import RowCountLogger  # noqa: E402
from millrace.streaming.rolling import topic_to_rolled_json_files  # noqa: E402
from millrace.workspace import path_from_env, scratch  # noqa: E402

logger = logging.getLogger("millrace")

TABLE_JOBS = ("filter-csv", "trip-table", "rewrite-partitions")
STREAM_JOBS = (
    "follow-topic",
    "topic-to-json-files",
    "topic-to-rolled-json-files",
    "topic-to-parquet-files",
    "topic-to-table",
)
# JSON as it comes; the others decode messages, and put those that are none aside
RAW_JOBS = ("topic-to-json-files", "topic-to-rolled-json-files")


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    add = parser.add_argument
    add("job", choices=(*TABLE_JOBS, "fill-topic", *STREAM_JOBS))
    add("--input", default=path_from_env("INPUT_PATH", ""))
    add("--output", default=path_from_env("OUTPUT_PATH", ""))
    add("--checkpoint", default=path_from_env("CHECKPOINT_PATH", ""))
    add("--servers", help="brokers; without them topics are folders")
    add("--topic", help="needed to fill a topic and to read from brokers")
    add("--format", choices=("avro", "json"), default="avro", help="of the messages")
    add("--schema-id", type=int, help="id in the header of Avro messages; none without")
    add(
        "--schema",
        action="append",
        default=[],
        metavar="ID=FILE",
        help="a further record that messages are written under, as a JSON file; repeatable",
    )
    add("--min-partitions", type=int, help="least parallelism of a broker source")
    add("--max-offsets", type=int, help="most messages a batch takes from a broker")
    add("--files-per-batch", type=int, help="most files a batch takes from a topic folder")
    add("--max-messages", type=int, help="most messages of a snapshot of topic-to-table")
    add("--rejects", default="", help="folder for JSON that does not parse; by default OUTPUT.rejects")
    add("--rest", default="", help="folder for what fills no file yet; by default OUTPUT.rest")
    add("--note", help="comment for the distance column of the trip table")
    add("--trigger", default="1 minute", help="interval, 'available-now' or 'none'")
    options = parser.parse_args(arguments)
    streams, brokers = options.job in STREAM_JOBS, bool(options.servers)
    needed = {
        "input": not (streams and brokers),
        "output": not (options.job == "fill-topic" and brokers),
        "checkpoint": streams,
        "topic": options.job == "fill-topic" or brokers,
    }
    for name, is_needed in needed.items():
        if is_needed and not getattr(options, name):
            parser.error(f"{options.job} needs --{name}")
    for name, fits in (
        ("min_partitions", brokers),
        ("max_offsets", brokers),
        ("files_per_batch", not brokers),
    ):
        if getattr(options, name) is not None and not (streams and fits):
            source = "a folder" if name == "files_per_batch" else "brokers (--servers)"
            parser.error(f"--{name.replace('_', '-')} is for streams from {source}")
    return options


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.job in STREAM_JOBS:
        counter = RowCountLogger()
        spark.streams.addListener(counter)
        try:
            aside = start_rejects(spark, options)
            start_stream(spark, options).awaitTermination()
            if aside is not None:
                aside.awaitTermination()
        finally:
            spark.streams.removeListener(counter)
    elif options.job == "filter-csv":
        counts = jobs.filter_csv(spark, options.input, options.output)
        logger.info("rows read: %d, rows kept: %d", *counts)
    elif options.job == "trip-table":
        rows = _trips(spark, options)
        counts = jobs.keep_trip_table(spark, rows, options.output, note=options.note)
        logger.info("rows created: %d, after deletes: %d, after rollback: %d", *counts)
    elif options.job == "rewrite-partitions":
        jobs.rewrite_partitions(_trips(spark, options), options.output)
    else:
        fill_topic(spark, options)


def fill_topic(spark: SparkSession, options: argparse.Namespace) -> None:
    rows = _trips(spark, options)
    if options.format == "json":
        messages = jobs.json_messages(rows)
    else:
        messages = jobs.avro_messages(rows, schema_id=options.schema_id)
    if options.servers:
        write_kafka(messages, options.servers, options.topic)
    else:
        write_topic(messages, options.output, options.topic)


def start_stream(spark: SparkSession, options: argparse.Namespace) -> StreamingQuery:
    messages, trigger = _messages(spark, options), _trigger(options)
    output, checkpoint = options.output, options.checkpoint
    if options.job == "topic-to-json-files":
        return sinks.topic_to_json_files(messages, output, checkpoint, trigger=trigger)
    if options.job == "topic-to-rolled-json-files":
        rest = options.rest or f"{output}.rest"
        return topic_to_rolled_json_files(messages, output, rest, checkpoint, trigger=trigger)
    if options.format == "json":
        messages, decode, _ = split_json_messages(messages, TAXI)
    else:
        decode = _avro(options)
    if options.job == "topic-to-parquet-files":
        return sinks.topic_to_parquet_files(messages, decode, output, checkpoint, trigger=trigger)
    if options.job == "topic-to-table":
        return sinks.topic_to_table(
            messages, decode, output, checkpoint, trigger, max_messages=options.max_messages
        )
    rows = messages.select(decode.alias("data")).select("data.*")
    return sinks.stream_to_parquet(rows, output, checkpoint, trigger)


def start_rejects(spark: SparkSession, options: argparse.Namespace) -> StreamingQuery | None:
    """A second stream that keeps JSON messages which do not parse, so that none stops the job."""
    if options.format != "json" or options.job in RAW_JOBS:
        return None
    _, _, rejects = split_json_messages(_messages(spark, options), TAXI)
    path = options.rejects or f"{options.output}.rejects"
    return sinks.stream_to_parquet(rejects, path, f"{options.checkpoint}-rejects", _trigger(options))


def _messages(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.servers:
        return kafka_stream(
            spark, options.servers, options.topic, options.min_partitions, options.max_offsets
        )
    return stream_topic(spark, options.input, options.files_per_batch)


def _trigger(options: argparse.Namespace) -> sinks.Trigger | None:
    ends = {"available-now": sinks.AVAILABLE_NOW, "none": None}
    return ends.get(options.trigger, {"processingTime": options.trigger})


def _trips(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    return read_csv(spark, options.input, TAXI)


def _avro(options: argparse.Namespace) -> Column:
    if options.schema_id is None:
        return from_avro("value", TAXI_RECORD)
    records = {options.schema_id: TAXI_RECORD}
    for given in options.schema:
        schema_id, _, file = given.partition("=")
        records[int(schema_id)] = json.loads(Path(file).read_text())
    return from_framed_avro("value", records, TAXI_RECORD)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    options = parse()
    session = SparkSession.builder.appName("millrace").getOrCreate()
    try:
        with scratch(session):
            run(session, options)
    finally:
        session.stop()
