"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) of all nodes of edges (a, b), a component named by its least node.

    Large and small stars in turn: each node hands its larger neighbours, then all its
    smaller ones, to the least node it knows. Minima are taken map-side and only edges are
    kept, so that a node with very many neighbours is no special case. Rounds grow with the
    logarithm of the longest chain. Each round is written before the next reads it.
    """
    spark = edges.sparkSession
    now = written(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _fingerprint(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .distinct()
        )
        # nodes that are least of all their neighbours keep their edges through those
        large = written(large, "large-star")
        smallest = large.groupBy("u").agg(F.min("v").alias("least"))
        small = (
            large.join(smallest, "u")
            .where("v != least")
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionByName(smallest.select("u", F.col("least").alias("v")))
            .where("u != v")
            .distinct()
        )
        now = written(small, "small-star")
        before, mark = mark, _fingerprint(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    ).first()
    return tuple(row)
