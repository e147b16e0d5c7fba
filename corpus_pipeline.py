"""Stages that turn raw documents into packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontaminate import without_leaks
from millrace.llm.ngram_join import one_of_each
from millrace.llm.packing import packed, tokenized_pieces
from millrace.llm.quality import text_counts, with_verdicts
from millrace.llm.secrets import without_secrets
from millrace.llm.shared import written
from millrace.operators.numbering import free_names

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the cutoffs of their language and source."""
    counts, kept = free_names(docs.columns, "counts", "kept")
    measured = written(docs.withColumn(counts, text_counts("text")), "measured")
    judged = with_verdicts(measured, counts, kept)
    return judged.where(F.col(kept)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain less than half of every benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by their kinds."""
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("text", without_secrets("text")).withColumn(
        "n_chars", F.length("text").cast(kind)
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in pieces, each with its place in a sequence.

    The pieces of a sequence, by offset, are its tokens.
    """
    pieces = tokenized_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed(written(pieces.withColumnRenamed("id", "doc_id"), "pieces"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: No stage of the whole run can be told in SQL; tests/llm compares it with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
