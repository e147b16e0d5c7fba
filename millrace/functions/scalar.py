"""Arithmetic and three-valued logic used by row-level changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_ratio(dividend: Column | str, divisor: Column | str) -> Column:
    """dividend / divisor as FLOAT; NULL where the divisor is zero or either side is NULL."""
    return F.try_divide(dividend, divisor).cast("float")


def is_true(condition: Column) -> Column:
    """The condition with NULL read as false."""
    return F.coalesce(condition, F.lit(False))
