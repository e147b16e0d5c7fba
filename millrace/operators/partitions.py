"""Parquet tables with one directory per partition value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.workspace import BARE_FILES, path_exists, scratch, staged

# what Spark's scan of whole files has, ahead of the partition columns
_FILE_COLUMNS = (
    StructType()
    .add("path", "string")
    .add("modificationTime", "timestamp")
    .add("length", "long")
    .add("content", "binary")
)

_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTINGS_PER_CORE = 8


class PartitionConflict(Exception):
    """A write would add to a partition that already has data."""


def write_partitioned(
    df: DataFrame,
    path: str,
    by: list[str],
    mode: str = "errorifexists",
    replace: str = "all",
) -> None:
    """Write one directory per value of ``by``.

    With ``mode="overwrite"``, ``replace="all"`` drops every old partition and
    ``replace="present"`` only those that ``df`` has rows for.

    Rows are first brought together by partition value, so each partition gets a few
    full files rather than one from every task. REBALANCE splits a value with far more
    rows than the rest over several tasks, so no task takes a hot partition alone.

    With many values the cost is that of the files and folders, so ``BARE_FILES`` keeps Spark
    from adding to them. Parquet has checksums of its own.
    """
    if replace not in ("all", "present"):
        raise ValueError(f"replace must be all or present, not {replace}")
    writer = df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).options(**BARE_FILES)
    if mode == "overwrite":
        writer = writer.option(
            "partitionOverwriteMode", "static" if replace == "all" else "dynamic"
        )
    writer.parquet(path)


def read_partitioned(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Scan a partitioned table; a filter on a partition column skips whole directories.

    Without a schema Spark guesses partition types from directory names: a string
    column whose values look like numbers comes back as numbers.

    Directories are listed by a few tasks a core, many to a task; as a rule Spark starts a
    task for each of the first ten thousand, which costs far more than to list it.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    usual = spark.conf.get(_LISTING_TASKS)
    few = _LISTINGS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set(_LISTING_TASKS, min(int(usual), few))
    try:
        return reader.parquet(path)
    finally:
        spark.conf.set(_LISTING_TASKS, usual)


def existing_partitions(
    spark: SparkSession, path: str, partition_schema: StructType
) -> DataFrame | None:
    """The partition values that have files under ``path``, None where nothing was written.

    Values come from directory names; no file is opened, and each task puts out its
    distinct values only.
    """
    if not path_exists(spark, path):
        return None
    files = spark.read.format("binaryFile")
    if not set(partition_schema.names) <= set(files.load(path).columns):
        return None
    schema = StructType([*_FILE_COLUMNS.fields, *partition_schema.fields])
    return files.schema(schema).load(path).select(*partition_schema.names).distinct()


def conflicting_partitions(df: DataFrame, path: str, by: list[str]) -> DataFrame:
    """Partition values of ``df`` that already have data under ``path``."""
    new = df.select(*by).distinct()
    present = existing_partitions(df.sparkSession, path, new.schema)
    if present is None:
        return new.where(F.lit(False))
    same = [new[name].eqNullSafe(present[name]) for name in by]
    return new.join(present, on=same, how="left_semi")


def append_new_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Append, but write nothing and fail if any partition already has data.

    The rows are evaluated once, into a folder of their own, whatever the check finds.
    """
    with scratch(df.sparkSession):
        df = staged(df, "append")
        clashes = conflicting_partitions(df, path, by).limit(5).collect()
        if clashes:
            shown = ", ".join(str(row.asDict()) for row in clashes)
            raise PartitionConflict(f"partitions already have data, among them: {shown}")
        write_partitioned(df, path, by, mode="append")
