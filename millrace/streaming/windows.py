"""Event-time windows, sessions, joins and replays of streams, with state that stays bounded.

Every function sets a watermark, ``delay`` behind the newest time seen; rows that come later
than that no longer count, and Spark drops the state of what they could have changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.sinks import QUERY_ID, Trigger, start
from millrace.workspace import large_state


def stream_window_totals(
    rows: DataFrame,
    time: str,
    width: str,
    by: Sequence[str],
    totals: dict[str, Column],
    path: str,
    checkpoint: str,
    delay: str,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Keep totals of tumbling windows up to date in a folder; ``window_totals`` reads them.

    Each batch writes the windows it changed, in a folder of its own, so that readers need not
    wait for windows to close and a batch that is run again replaces its own. Rows without
    a time are in no window. Groups with a third of all rows are no burden: tasks send one
    row per window and group.
    """
    grouped = rows.withWatermark(time, delay).groupBy(F.window(time, width).alias("span"), *by)
    found = grouped.agg(*(value.alias(name) for name, value in totals.items()))
    result = found.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        *by,
        *totals,
    )

    def keep(batch: DataFrame, number: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        place = f"{path}/stream={query_id}/batch={number}"
        batch.write.mode("overwrite").parquet(place)

    writer = result.writeStream.outputMode("update").foreachBatch(keep)
    with large_state(rows.sparkSession):
        return start(writer, checkpoint, trigger)


def window_totals(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """The newest totals of each window and group that ``stream_window_totals`` wrote."""
    written = spark.read.option("mergeSchema", "false").parquet(path)
    keys = ["stream", "window_start", "window_end", *by]
    rest = [name for name in written.columns if name not in (*keys, "batch")]
    newest = written.groupBy(*keys).agg(F.max(F.struct("batch", *rest)).alias("newest"))
    return newest.select("window_start", "window_end", *by, *(f"newest.{name}" for name in rest))


def sessions(
    rows: DataFrame, time: str, gap: str, by: Sequence[str], totals: dict[str, Column], delay: str
) -> DataFrame:
    """Sessions of a stream or table: rows of a group, each at most ``gap`` after the one before.

    Of a stream a session comes out when the watermark has passed its end; until then
    only its totals are held. Tasks merge their own sessions ahead of the shuffle.
    """
    marked = rows.withWatermark(time, delay) if rows.isStreaming else rows
    span = F.session_window(time, gap).alias("span")
    found = marked.groupBy(span, *by).agg(*(value.alias(name) for name, value in totals.items()))
    return found.select(
        F.col("span.start").alias("session_start"),
        F.col("span.end").alias("session_end"),
        *by,
        *totals,
    )


def join_within(
    left: DataFrame,
    right: DataFrame,
    keys: dict[str, str],
    times: tuple[str, str],
    within: str,
    delay: str,
    how: str = "inner",
) -> DataFrame:
    """Rows of ``right`` from the time of a row of ``left`` up to ``within`` later, keys equal.

    Column names of the two sides must differ. Of streams, rows are held until the watermark tells
    that no partner can come; with ``how="leftOuter"`` a row without one comes out then.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    if left.isStreaming:
        left, right = left.withWatermark(times[0], delay), right.withWatermark(times[1], delay)
    early, late = F.col(times[0]), F.col(times[1])
    matches = (late >= early) & (late <= early + F.expr(f"INTERVAL {within}"))
    for one, other in keys.items():
        matches = matches & (F.col(one) == F.col(other))
    return left.join(right, matches, how)


def without_replays(
    messages: DataFrame,
    delay: str,
    place: Sequence[str] = ("topic", "partition", "offset"),
    time: str = "timestamp",
) -> DataFrame:
    """Each message of a stream once, however often its source delivers it within ``delay``.

    The state is one small key per message until the watermark has passed; a replay that
    comes later than that is dropped as too late.
    """
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(place))


def late_rows(query: StreamingQuery) -> int:
    """Rows (or the totals tasks made of them) that came behind the watermark, of recent batches."""
    return sum(
        state.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for state in progress.stateOperators
    )
