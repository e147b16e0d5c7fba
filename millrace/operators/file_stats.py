"""Row count, null counts and value bounds of each Parquet file."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import date, datetime
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    LongType,
    MapType,
    StringType,
    StructType,
    TimestampType,
    VariantType,
)

from millrace.workspace import is_plain_file_path

STATS = (
    StructType()
    .add("uri", "string")
    .add("path", "string")
    .add("file_size", "long")
    .add("record_count", "long")
    .add("null_value_counts", MapType(StringType(), LongType()))
    .add("lower_bounds", MapType(StringType(), StringType()))
    .add("upper_bounds", MapType(StringType(), StringType()))
)
_ARROW_STATS = pa.schema(
    [
        ("uri", pa.string()),
        ("path", pa.string()),
        ("file_size", pa.int64()),
        ("record_count", pa.int64()),
        ("null_value_counts", pa.map_(pa.string(), pa.int64())),
        ("lower_bounds", pa.map_(pa.string(), pa.string())),
        ("upper_bounds", pa.map_(pa.string(), pa.string())),
    ]
)
_UNORDERED = (ArrayType, BinaryType, MapType, StructType, VariantType)


def list_parquet(spark: SparkSession, root: str) -> DataFrame:
    """uri, path and size of every Parquet file below ``root``; none is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select(
            F.col("_metadata.file_path").alias("uri"), "path", F.col("length").alias("file_size")
        )
    )


def stats_by_scan(df: DataFrame) -> DataFrame:
    """Statistics of the files a Parquet scan reads, by grouping its rows per file.

    Map-side partial aggregation leaves one row per file and task to shuffle. ``df``
    must be the scan itself; select fewer columns first to read fewer.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, _UNORDERED)]

    def per_column(make, names: list[str]) -> Column:
        pairs = [part for name in names for part in (F.lit(name), make(_quoted(name), name))]
        return F.create_map(*pairs)

    def as_text(value: Column, name: str) -> Column:
        if isinstance(df.schema[name].dataType, TimestampType):  # also right in another zone
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
        return value.cast("string")

    def known(bounds: Column) -> Column:
        return F.map_filter(bounds, lambda _, value: value.isNotNull())

    uri = F.col("_metadata.file_path")
    return df.groupBy(uri.alias("uri")).agg(
        F.count("*").alias("record_count"),
        per_column(lambda c, _: F.count_if(c.isNull()), df.columns).alias("null_value_counts"),
        known(per_column(lambda c, n: as_text(F.min(c), n), plain)).alias("lower_bounds"),
        known(per_column(lambda c, n: as_text(F.max(c), n), plain)).alias("upper_bounds"),
    )


def stats_from_footers(files: DataFrame) -> DataFrame:
    """The same from Parquet footers, one small read per file instead of a scan.

    For paths that executors reach as plain files. Bounds a footer lacks are left out.
    """
    return files.select("uri", "path", "file_size").mapInArrow(_read_footers, STATS)


def describe_files(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """STATS rows for the Parquet files below ``root``, by footers if they can be opened."""
    files = list_parquet(spark, root)
    if is_plain_file_path(spark, root):
        # listing packs files by size, as if they would be read: few tasks are enough
        return stats_from_footers(files.coalesce(spark.sparkContext.defaultParallelism))
    scan = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
    return files.join(stats_by_scan(scan), "uri").selectExpr(*STATS.names)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _text(value: Any) -> str | None:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return None if isinstance(value, bytes) else str(value)


def _texts(bounds: dict[str, Any]) -> list[tuple[str, str]]:
    texts = ((name, _text(value)) for name, value in bounds.items())
    return [(name, text) for name, text in texts if text is not None]


def _pickle_by_value() -> None:
    """Ship this module's functions with the tasks, so workers need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_pickle_by_value()


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for file in batch.to_pylist():
            footer = pq.read_metadata(file["path"].removeprefix("file:"))
            nulls: dict[str, int] = {}
            lower: dict[str, Any] = {}
            upper: dict[str, Any] = {}
            unknown = set()
            for group in range(footer.num_row_groups):
                for index in range(footer.num_columns):
                    chunk = footer.row_group(group).column(index)
                    name, stats = chunk.path_in_schema, chunk.statistics
                    if name != footer.schema.column(index).name:  # inside a nested column
                        continue
                    if stats is None or not stats.has_null_count:
                        unknown.add(name)
                        continue
                    nulls[name] = nulls.get(name, 0) + stats.null_count
                    if stats.has_min_max:
                        lower[name] = min(lower.get(name, stats.min), stats.min)
                        upper[name] = max(upper.get(name, stats.max), stats.max)
                    elif stats.null_count < chunk.num_values:
                        unknown.add(name)
            for known in (nulls, lower, upper):
                for name in unknown & known.keys():
                    del known[name]
            rows.append(
                {
                    **file,
                    "record_count": footer.num_rows,
                    "null_value_counts": list(nulls.items()),
                    "lower_bounds": _texts(lower),
                    "upper_bounds": _texts(upper),
                }
            )
        yield pa.RecordBatch.from_pylist(rows, _ARROW_STATS)
