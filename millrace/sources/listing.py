"""What lies under an output prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per data object below ``path``: path, length and modification time.

    The listing is a file scan whose ``content`` column is never selected, so no
    object is opened. Objects are planned by their size, as if they would be read, so
    their many tasks are put together to a few.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
        .coalesce(spark.sparkContext.defaultParallelism)
    )


def folder_summary(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Object count and total bytes of each folder below ``path`` that has objects itself.

    Folders are named by their path, without the slash at the end.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    return list_objects(spark, path, pattern).groupBy(folder).agg(
        F.count("*").alias("objects"), F.sum("length").alias("total_bytes")
    )


def listing_summary(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Object count and total bytes below ``path``."""
    return list_objects(spark, path, pattern).agg(
        F.count("*").alias("objects"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
    )
