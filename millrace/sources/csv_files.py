"""CSV scans and the CSV sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.numbering import by_whole_chunks, free_names, in_chunks, row_in_task
from millrace.workspace import fresh_dir, path_exists

# The writer's default keeps milliseconds only; both sides name the full pattern.
_TIME_FORMAT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_csv(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """Scan CSV with a header line under a fixed schema; a cell that does not parse is NULL.

    So is an empty string, unless both sides set another ``nullValue``.
    """
    return spark.read.options(header="true", **_TIME_FORMAT, **options).schema(schema).csv(path)


def read_csv_inferred(
    spark: SparkSession, path: str, casts: dict[str, str] | None = None, **options: str
) -> DataFrame:
    """Scan CSV with types found by Spark, then adjusted by ``casts`` (column to type).

    Inference is a pass of its own over the files. ``samplingRatio`` shortens it at
    the risk of a type that later cells do not fit, so no ratio is set here.
    """
    df = spark.read.options(header="true", inferSchema="true", **options).csv(path)
    return df.withColumns({name: df[name].cast(kind) for name, kind in (casts or {}).items()})


def register_path(
    spark: SparkSession,
    view: str,
    path: str,
    schema: StructType,
    fmt: str = "csv",
    **options: str,
) -> None:
    """Give a file path a name that SQL can select from."""
    defaults = {"header": "true", **_TIME_FORMAT} if fmt == "csv" else {}
    df = spark.read.format(fmt).options(**{**defaults, **options}).schema(schema).load(path)
    df.createOrReplaceTempView(view)


def stream_csv(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int, **options: str
) -> DataFrame:
    """Read a folder of CSV files in bounded chunks, so many files per micro-batch."""
    return (
        spark.readStream.options(header="true", **_TIME_FORMAT, **options)
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(schema)
        .csv(path)
    )


def read_csv_chunks(
    spark: SparkSession, path: str, schema: StructType, rows_per_chunk: int, **options: str
) -> DataFrame:
    """Scan CSV in chunks of exactly so many rows, the last one aside, in file and line order.

    ``chunk`` and ``chunk_row`` tell each row's place. Tasks read splits of files as ever; a
    chunk may begin in one split and end in the next.
    """
    place = {"csv file": "_metadata.file_path", "csv block": "_metadata.file_block_start"}
    rows = read_csv(spark, path, schema, **options).select(
        "*", *(F.col(source).alias(name) for name, source in place.items())
    )
    return in_chunks(rows, rows_per_chunk, segments=list(place)).drop(*place)


def stream_csv_chunks(
    spark: SparkSession, path: str, schema: StructType, rows_per_batch: int, **options: str
) -> DataFrame:
    """Follow what a CSV folder holds now in micro-batches of exactly so many rows, but for one.

    The rows are first written as one file per chunk, without the line order of chunks.
    """
    chunked = read_csv_chunks(spark, path, schema, rows_per_batch, **options)
    target = fresh_dir(spark, "csv-chunks")
    whole = by_whole_chunks(chunked).drop("chunk", "chunk_row")
    whole.write.option("maxRecordsPerFile", rows_per_batch).parquet(target)
    return spark.readStream.option("maxFilesPerTrigger", 1).schema(schema).parquet(target)


def stream_csv_chunk_lanes(
    spark: SparkSession, path: str, schema: StructType, rows_per_batch: int, lanes: int, **options: str
) -> list[DataFrame]:
    """``stream_csv_chunks`` as several streams to run side by side, chunks dealt to them in turn.

    A micro-batch of a bounded size is one task and some planning, so one stream after
    another would leave most of a cluster idle.
    """
    chunked = read_csv_chunks(spark, path, schema, rows_per_batch, **options)
    (lane,) = free_names(chunked.columns, "lane")
    target = fresh_dir(spark, "csv-chunks")
    dealt = chunked.withColumn(lane, F.col("chunk") % lanes)
    whole = by_whole_chunks(dealt, [lane]).drop("chunk", "chunk_row")
    whole.write.partitionBy(lane).option("maxRecordsPerFile", rows_per_batch).parquet(target)
    reader = spark.readStream.option("maxFilesPerTrigger", 1).schema(schema)
    folders = (f"{target}/{lane}={number}" for number in range(lanes))
    return [reader.parquet(folder) for folder in folders if path_exists(spark, folder)]


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", **options: str) -> None:
    """Write CSV with a header line; by default an existing path is an error."""
    df.write.mode(mode).options(header="true", **_TIME_FORMAT, **options).csv(path)


def write_csv_lanes(
    df: DataFrame, path: str, rows_per_file: int, lanes: int, **options: str
) -> list[str]:
    """Write CSV files of at most so many rows, dealt in turn to folders; those that got any.

    Rows stay in their tasks, and each task deals its own files.
    """
    (lane,) = free_names(df.columns, "lane")
    dealt = df.withColumn(
        lane, F.floor(row_in_task() / rows_per_file + F.spark_partition_id()) % lanes
    )
    writer = dealt.write.partitionBy(lane).option("maxRecordsPerFile", rows_per_file)
    writer.options(header="true", **_TIME_FORMAT, **options).csv(path)
    folders = (f"{path}/{lane}={number}" for number in range(lanes))
    return [folder for folder in folders if path_exists(df.sparkSession, folder)]

