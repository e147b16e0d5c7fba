"""How many rows a stream has taken in."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

logger = logging.getLogger(__name__)


class RowCountLogger(StreamingQueryListener):
    """Logs a running total after each batch; add it with ``spark.streams.addListener``.

    It counts from its own start, or from ``totals`` by query id, such as the last ones of
    ``running_totals``.
    """

    def __init__(self, totals: dict[str, int] | None = None) -> None:
        self.totals: dict[str, int] = dict(totals or {})

    def onQueryStarted(self, event) -> None:
        self.totals.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        name = str(event.progress.id)
        self.totals[name] = self.totals.get(name, 0) + event.progress.numInputRows
        logger.info("stream %s: %d rows so far", name, self.totals[name])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def running_totals(spark: SparkSession, counts: str) -> DataFrame:
    """Rows (stream, batch, rows, total_rows) of a folder that ``stream_with_counts`` wrote.

    All batches count, whatever Spark still remembers of them and however often the
    stream was restarted.
    """
    schema = "rows bigint, stream string, batch bigint"
    batches = spark.read.schema(schema).parquet(counts)
    so_far = Window.partitionBy("stream").orderBy("batch")
    return batches.select(
        "stream", "batch", "rows", F.sum("rows").over(so_far).alias("total_rows")
    )
