"""Subtotals over several groupings at once, and the first rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def subtotals(
    rows: DataFrame, groupings: Sequence[Sequence[str]], totals: dict[str, Column]
) -> DataFrame:
    """Totals for each of several groupings, in one shuffle of partial results.

    Columns that a row's grouping leaves out are NULL in it; ``grouping_id`` has a bit for each,
    the first column's highest, so that they differ from NULLs of the data.
    """
    names = list(dict.fromkeys(name for grouping in groupings for name in grouping))
    if not names:
        raise ValueError("no column in any grouping")
    grouped = rows.groupingSets(list(map(list, groupings)), *names)
    found = [value.alias(name) for name, value in totals.items()]
    return grouped.agg(F.grouping_id().cast("int").alias("grouping_id"), *found)


def cube(rows: DataFrame, columns: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """``subtotals`` for all subsets of the columns."""
    subsets: list[list[str]] = [[]]
    for name in columns:
        subsets += [[*subset, name] for subset in subsets]
    return subtotals(rows, subsets, totals)


def first_of_each(
    rows: DataFrame, by: Sequence[str], order: Sequence[Column], count: int, ties: bool = False
) -> DataFrame:
    """The first ``count`` rows of each group with their place in ``rank``; with ``ties`` equals too.

    The limit is on the rank itself, so Spark keeps no more than that of each group in every
    task before rows are shuffled: a group with a third of all rows is never sorted as a whole.
    """
    if "rank" in rows.columns:
        raise ValueError("column rank is there already")
    window = Window.partitionBy(*by).orderBy(*order)
    place = F.rank() if ties else F.row_number()
    return rows.withColumn("rank", place.over(window)).where(F.col("rank") <= count)
