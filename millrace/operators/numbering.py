"""Consecutive row numbers over all tasks, and chunks of an exact size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.workspace import staged

# monotonically_increasing_id counts rows of a task in its lower bits
_ROW_BITS = 33


def numbered(
    rows: DataFrame,
    name: str,
    by: Sequence[str] = (),
    order: Sequence[str] = (),
    segments: Sequence[str] = (),
) -> DataFrame:
    """Adds a column of numbers from 0 without gaps, for each group ``by`` if given.

    With ``order`` the rows are sorted over all tasks, and numbers repeat exactly on the same
    rows if it has no ties. Else rows count task by task as they are read, or in the order of
    ``segments``, columns that tell which stretch of a file a row is from. No group is
    gathered: each task counts its own rows, and one small row per task and group tells
    where its numbers start. The rows are written once, so that they are not evaluated anew
    for the second look. NULLs of a group are one group.
    """
    if by and not order or segments and order:
        raise ValueError("groups need an order, and segments are one")
    if name in rows.columns:
        raise ValueError(f"column exists: {name}")
    task, place, shift = free_names(rows.columns, "task", "place", "shift")
    keys = [*by, *order]
    if keys:
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = staged(
        rows.withColumns({task: F.spark_partition_id(), place: row_in_task()}), "numbered"
    )
    counts = placed.groupBy(task, *by, *segments).agg(
        F.min(place).alias("first"), F.count("*").alias("rows")
    )
    # one row per task and group (or stretch of a file); without groups all in one window
    earlier = Window.partitionBy(*by).orderBy(*segments, task)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    of = {column: f"of {column}" for column in (task, *by, *segments)}
    starts = staged(
        counts.select(*(F.col(c).alias(n) for c, n in of.items()), (before - F.col("first")).alias(shift)),
        "starts",
    )
    same = [placed[column].eqNullSafe(starts[other]) for column, other in of.items()]
    found = placed.join(starts, _all(same))
    return found.select(*rows.columns, (F.col(place) + F.col(shift)).alias(name))


def row_in_task() -> Column:
    """The number of a row among those of its task."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def in_chunks(
    rows: DataFrame,
    size: int,
    by: Sequence[str] = (),
    order: Sequence[str] = (),
    segments: Sequence[str] = (),
) -> DataFrame:
    """Adds ``chunk`` and ``chunk_row``: every chunk but the last (of its group) has ``size`` rows."""
    if size < 1:
        raise ValueError("a chunk has at least one row")
    if {"chunk", "chunk_row"} & set(rows.columns):
        raise ValueError("columns chunk and chunk_row are there already")
    (number,) = free_names(rows.columns, "number")
    found = numbered(rows, number, by, order, segments)
    return found.select(
        *rows.columns,
        F.expr(f"`{number}` div {size}").alias("chunk"),
        (F.col(number) % size).alias("chunk_row"),
    )


def by_whole_chunks(chunked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``in_chunks``, each chunk in one task, ready to be written with a file for each.

    In every task chunks follow each other in order, and only the last of a group is short. So
    a writer that starts a new file after ``size`` rows writes one chunk to a file, if
    groups go to folders of their own.
    """
    keys = [*by, "chunk"]
    return chunked.repartition(*keys).sortWithinPartitions(*keys, "chunk_row")


def free_names(taken: Sequence[str], *wanted: str) -> list[str]:
    """Names close to those wanted that no column has."""
    lower = {name.lower() for name in taken}
    found = []
    for name in wanted:
        while name.lower() in lower:
            name += "_"
        found.append(name)
    return found


def _all(conditions: Sequence[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result
