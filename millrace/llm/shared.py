"""Written intermediate tables, so that a lost executor costs no earlier stage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.workspace import fresh_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of a DataFrame, written to the folder all executors share and read back."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
