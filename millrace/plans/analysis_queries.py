"""Subtotals, ranks, and event time: windows, sessions, joins and replays of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.messages import from_json_payload, json_payload
from millrace.operators.grouping import cube, first_of_each, subtotals
from millrace.plans.registry import query, table
from millrace.sources.topic import read_topic, stream_topic, write_topic
from millrace.streaming.sinks import AVAILABLE_NOW, stream_to_parquet
from millrace.streaming.windows import (
    join_within,
    sessions,
    stream_window_totals,
    window_totals,
    without_replays,
)
from millrace.workspace import fresh_dir


def _line_totals() -> dict:
    return {"lines": F.count("*"), "quantity": F.sum("l_quantity")}


@query(
    "SELECT l_returnflag, l_linestatus, YEAR(l_shipdate) AS shipped, "
    "CAST(GROUPING_ID(l_returnflag, l_linestatus, YEAR(l_shipdate)) AS INTEGER) AS grouping_id, "
    "COUNT(*) AS lines, SUM(l_quantity) AS quantity FROM lineitem "
    "GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag, YEAR(l_shipdate)), ())"
)
def grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("shipped", F.year("l_shipdate").cast("long"))
    groupings = (("l_returnflag", "l_linestatus"), ("l_returnflag", "shipped"), ())
    return subtotals(lines, groupings, _line_totals())


@query(
    "SELECT l_returnflag, l_linestatus, "
    "CAST(GROUPING_ID(l_returnflag, l_linestatus) AS INTEGER) AS grouping_id, "
    "COUNT(*) AS lines, SUM(l_quantity) AS quantity FROM lineitem "
    "GROUP BY CUBE (l_returnflag, l_linestatus)"
)
def cube_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return cube(lines, ("l_returnflag", "l_linestatus"), _line_totals())


@query(
    "SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, rank FROM (SELECT *, "
    "ROW_NUMBER() OVER (PARTITION BY l_suppkey "
    "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_quantity) AS rank FROM lineitem) "
    "WHERE rank <= 3"
)
def top_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three dearest lines of each supplier."""
    lines = table(spark, sf_dir, "lineitem")
    order = (F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_quantity")
    best = first_of_each(lines, ("l_suppkey",), order, 3)
    place = F.col("rank").cast("long").alias("rank")
    return best.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", place)


# ------------------------------------------------------------------ event time

_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
#: Longer than the tables last, so that no row is late whatever order files are read in.
_DELAY = "3650 days"


def _topic(spark: SparkSession, sf_dir: str, last: bool = False) -> str:
    """Events as JSON messages; with ``last`` one more from long after, which moves the watermark."""
    path = fresh_dir(spark, "json-topic")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    write_topic(events.select(json_payload().alias("value")), path, "events")
    if last:
        beat = events.agg(F.max("ts").alias("ts")).select(
            F.lit(-1).cast("long").alias("event_id"),
            (F.col("ts") + F.expr("INTERVAL 7500 DAYS")).alias("ts"),
            F.lit(-1).cast("long").alias("user_id"),
            F.lit("beat").alias("event_type"),
            F.lit(0.0).alias("value"),
        )
        write_topic(beat.select(json_payload().alias("value")), path, "events")
    return path


def _parsed(messages: DataFrame) -> DataFrame:
    schema = messages.sparkSession.createDataFrame([], _SCHEMA).schema
    data = from_json_payload("value", schema, mode="FAILFAST").alias("data")
    # watermarks need the type of an instant
    return _cast(messages.select(data).select("data.*"), "timestamp", "ts")


def _cast(rows: DataFrame, kind: str, *names: str) -> DataFrame:
    return rows.withColumns({name: F.col(name).cast(kind) for name in names})


@query(
    "SELECT TIME_BUCKET(INTERVAL 1 HOUR, ts) AS window_start, "
    "TIME_BUCKET(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, "
    "COUNT(*) AS events, MAX(value) AS largest FROM events GROUP BY ALL"
)
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by hour and type, kept up to date over several batches."""
    target = fresh_dir(spark, "windows")
    stream_window_totals(
        _parsed(stream_topic(spark, _topic(spark, sf_dir), files_per_batch=1)),
        "ts",
        "1 hour",
        ["event_type"],
        {"events": F.count("*"), "largest": F.max("value")},
        f"{target}/totals",
        f"{target}/checkpoint",
        _DELAY,
        AVAILABLE_NOW,
    ).awaitTermination()
    found = window_totals(spark, f"{target}/totals", ["event_type"])
    return _cast(found, "timestamp_ntz", "window_start", "window_end")


_SESSIONS_SQL = (
    "WITH gaps AS (SELECT user_id, ts, value, CASE WHEN ts <= LAG(ts) OVER "
    "(PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM events), "
    "numbered AS (SELECT *, SUM(opens) OVER (PARTITION BY user_id ORDER BY ts "
    "ROWS UNBOUNDED PRECEDING) AS n FROM gaps) "
    "SELECT MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, user_id, "
    "COUNT(*) AS events FROM numbered GROUP BY user_id, n"
)


@query(_SESSIONS_SQL)
def batch_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return sessions(events, "ts", "30 minutes", ["user_id"], {"events": F.count("*")}, _DELAY)


@query(_SESSIONS_SQL)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions come out once the watermark has passed them; a last message sees to it."""
    target = fresh_dir(spark, "sessions")
    topic = _topic(spark, sf_dir, last=True)
    for _ in range(2):
        events = _parsed(stream_topic(spark, topic, files_per_batch=2))
        found = sessions(events, "ts", "30 minutes", ["user_id"], {"events": F.count("*")}, _DELAY)
        stream_to_parquet(found, target, f"{target}-checkpoint", AVAILABLE_NOW).awaitTermination()
    found = spark.read.parquet(target).where("user_id >= 0")
    return _cast(found, "timestamp_ntz", "session_start", "session_end")


_JOIN_SQL = (
    "SELECT v.event_id AS view_id, p.event_id AS purchase_id, v.user_id AS viewer "
    "FROM (SELECT * FROM events WHERE event_type = 'view') v LEFT JOIN "
    "(SELECT * FROM events WHERE event_type = 'purchase') p "
    "ON v.user_id = p.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 12 HOUR"
)


def _views_and_purchases(events: DataFrame) -> DataFrame:
    kept = F.col("event_type").isin("view", "beat"), F.col("event_type").isin("purchase", "beat")
    views, purchases = (
        events.where(kind).select(
            F.col("event_id").alias(f"{name}_id"),
            F.col("ts").alias(f"{name}_time"),
            F.col("user_id").alias(who),
        )
        for kind, name, who in zip(kept, ("view", "purchase"), ("viewer", "buyer"), strict=True)
    )
    joined = join_within(
        views,
        purchases,
        {"viewer": "buyer"},
        ("view_time", "purchase_time"),
        "12 HOURS",
        _DELAY,
        "leftOuter",
    )
    return joined.select("view_id", "purchase_id", "viewer")


@query(_JOIN_SQL)
def batch_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _views_and_purchases(table(spark, sf_dir, "events"))


@query(_JOIN_SQL)
def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views with purchases after them; a view without comes out when none can follow."""
    target = fresh_dir(spark, "joined")
    topic = _topic(spark, sf_dir, last=True)
    for _ in range(2):
        joined = _views_and_purchases(_parsed(stream_topic(spark, topic, files_per_batch=4)))
        stream_to_parquet(joined, target, f"{target}-checkpoint", AVAILABLE_NOW).awaitTermination()
    return spark.read.parquet(target).where("viewer >= 0")


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic whose messages are all delivered twice, in batches of their own."""
    topic, target = _topic(spark, sf_dir), fresh_dir(spark, "stream")
    for run in range(2):
        if run:
            read_topic(spark, topic).repartition(3).write.mode("append").parquet(topic)
        messages = without_replays(stream_topic(spark, topic, files_per_batch=4), "1 day")
        stream_to_parquet(
            _parsed(messages), target, f"{target}-checkpoint", AVAILABLE_NOW
        ).awaitTermination()
    return _cast(spark.read.parquet(target), "timestamp_ntz", "ts")
