"""Registered queries of the operators in this package."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.chat import perspectives
from millrace.llm.conversation_repair import (
    conversation_reports,
    distinct_turns,
    repaired_parts,
    turn_gaps,
    with_faults,
)
from millrace.llm.decontaminate import leaks
from millrace.llm.harmonic import harmonic_pieces, settled
from millrace.llm.lm_scoring import scores
from millrace.llm.ngram_join import set_components
from millrace.llm.packing import packed, tokenized_pieces
from millrace.llm.periodic_runs import periodic_runs
from millrace.llm.quality import COUNTS, base_failed, text_counts, with_verdicts
from millrace.llm.secrets import secret_spans
from millrace.llm.shared import written
from millrace.llm.sharding import placed
from millrace.llm.suffix_dedup import remove_repeats
from millrace.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register a function under its own name."""
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents without the bytes of 200-byte strings that occur again."""
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    docs = table(spark, sf_dir, "documents")
    measured = docs.select("doc_id", "lang", "source", text_counts("text").alias("counts"))
    judged = with_verdicts(written(measured, "counts"), "counts", "kept")
    return judged.select(
        "doc_id",
        *(F.col(f"counts.{name}") for name in COUNTS if name != "n_lines"),
        base_failed(F.col("counts")).alias("base_failed"),
        "kept",
        "counts.n_lines",
    )


def _listed(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


#: Counts, sketches and cutoffs as in ``quality``, written out.
CHECK_SQL["op5_quality_rules"] = r"""
WITH texts AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT *,
        list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
        list_filter(
            string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')
        ) AS lines
    FROM texts
), windows AS (
    SELECT doc_id, pos, words[pos : pos + 7] AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS pos FROM split)
), repeated AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (
        SELECT doc_id, unnest(range(pos, pos + 8)) AS place FROM windows
        JOIN (SELECT doc_id, w FROM windows GROUP BY ALL HAVING count(*) > 1) USING (doc_id, w)
    ) GROUP BY doc_id
), counts AS (
    SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
            AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM split LEFT JOIN repeated USING (doc_id)
), ratios AS (
    SELECT doc_id, lang, source, n_words, r.* FROM (
        SELECT doc_id, lang, source, n_words, unnest([
            {'ratio': 1, 'v': 1000000 * n_symbols // greatest(word_chars, 1), 'nearest': 20000},
            {'ratio': 2, 'v': 1000000 * word_chars // greatest(n_words, 1), 'nearest': 1500000},
            {'ratio': 3, 'v': 1000000 * n_dup_lines // greatest(n_lines, 1), 'nearest': 500000},
            {'ratio': 4, 'v': 1000000 * n_repeat_words // greatest(n_words, 1), 'nearest': 300000}
        ]) AS r FROM counts)
), bucketed AS (
    SELECT *, d * 32 + (v >> d) AS bucket FROM (
        SELECT *, CAST(greatest(length(bin(v)) - 6, 0) AS BIGINT) AS d FROM ratios WHERE n_words > 0)
), grouped AS (
    SELECT 0 AS level, lang, source, ratio, bucket, count(*) AS n FROM bucketed GROUP BY ALL
    UNION ALL SELECT 1, lang, NULL, ratio, bucket, count(*) FROM bucketed GROUP BY ALL
    UNION ALL SELECT 2, NULL, NULL, ratio, bucket, count(*) FROM bucketed GROUP BY ALL
), placed AS (
    SELECT *, sum(n) OVER (PARTITION BY level, lang, source, ratio ORDER BY bucket) AS upto,
        sum(n) OVER (PARTITION BY level, lang, source, ratio) AS total FROM grouped
), points AS (
    SELECT level, lang, source, ratio, total,
        min(bucket) FILTER (WHERE upto * 100 >= total * 10) AS b10,
        min(bucket) FILTER (WHERE upto * 100 >= total * 50) AS b50,
        min(bucket) FILTER (WHERE upto * 100 >= total * 90) AS b90
    FROM placed GROUP BY ALL
), limits AS (
    SELECT level, lang, source, ratio, total,
        (b10 - 32 * greatest(b10 // 32 - 1, 0)) << greatest(b10 // 32 - 1, 0) AS low,
        (b50 - 32 * greatest(b50 // 32 - 1, 0)) << greatest(b50 // 32 - 1, 0) AS mid,
        (b90 - 32 * greatest(b90 // 32 - 1, 0)) << greatest(b90 // 32 - 1, 0) AS high
    FROM points
), judged AS (
    SELECT ratios.doc_id, bool_and(v BETWEEN
        l.mid - greatest((l.mid - l.low) * 8, nearest) AND
        l.mid + greatest(least(l.mid - l.low, l.high - l.mid) * 8, nearest)) AS fine
    FROM ratios, LATERAL (
        SELECT low, mid, high FROM limits
        WHERE limits.ratio = ratios.ratio AND (
            level = 2
            OR level = 1 AND limits.lang IS NOT DISTINCT FROM ratios.lang AND total >= 100
            OR level = 0 AND limits.lang IS NOT DISTINCT FROM ratios.lang
                AND limits.source IS NOT DISTINCT FROM ratios.source AND total >= 100)
        ORDER BY level LIMIT 1) AS l
    GROUP BY ratios.doc_id
), based AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(fine, FALSE) AS kept, n_lines
FROM based LEFT JOIN judged USING (doc_id)
"""


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents; the digest covers the first three rules."""
    found = table(spark, sf_dir, "documents").select("doc_id", secret_spans("text").alias("found"))

    def of(kind: str) -> Column:
        return F.filter("found", lambda s: s["kind"] == kind)

    base = F.filter("found", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.withColumn("base", base).select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("found").alias("spans"),
    )


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens packed into sequences of at most 4096; a digest stands for ids."""
    docs = table(spark, sf_dir, "documents")
    pieces = tokenized_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed(
        written(
            pieces.select(
                F.col("id").alias("doc_id"),
                "piece",
                "start",
                "length",
                F.crc32("ids").alias("ids_crc32"),
            ),
            "pieces",
        )
    )


@query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents by the likeness of their sets of 5-word shingles."""
    found = set_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain half of a benchmark item or more, in any order."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents under a unigram model of 32,000 pieces."""
    counted = token_counts("text", public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", counted.alias("counted"))
    return docs.select("doc_id", "counted.*")


@query
def op3_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations for each participant, with spans as start-end."""
    views = perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return views.withColumn("mask", F.array_join(spans, ","))


#: Every turn for every speaker of its conversation; rendering as in ``chat.render``.
CHECK_SQL["op3_chat_perspectives"] = r"""
WITH said AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), views AS (
    SELECT DISTINCT conv_id, role AS perspective FROM said WHERE role <> 'system'
), numbered AS (
    SELECT *, (row_number() OVER (PARTITION BY conv_id, part
        ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1) // 256 AS split
    FROM (SELECT *, coalesce(turn, 0) // 256 AS part FROM said)
), pieces AS (
    SELECT conv_id, perspective, part, split, turn, role, text,
        '<|im_start|>' || CASE
            WHEN role = perspective THEN 'assistant'
            WHEN role = 'system' THEN 'system'
            ELSE 'user name=' || role END || chr(10) AS head,
        replace(coalesce(text, ''), '<|', '<\|') || '<|im_end|>' AS body
    FROM numbered JOIN views USING (conv_id)
), placed AS (
    SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
        PARTITION BY conv_id, perspective, part, split ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start
    FROM pieces
)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part,
    string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS rendered,
    coalesce(string_agg(
        CAST(start AS BIGINT) || '-' || CAST(start + length(body) AS BIGINT), ','
        ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FILTER (WHERE role = perspective), '') AS mask,
    CAST(split AS BIGINT) AS split
FROM placed GROUP BY conv_id, perspective, part, split
"""


@query
def op4_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 64 shards."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    shards = [f"shard-{number:02d}" for number in range(64)]
    spread = ("lang", "source", "n_chars")
    return placed(docs, "doc_id", shards, spread).select("doc_id", "slot", "shard")


@query
def op7_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; every seventh, by the hash of its id, is held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    scored = scores(table(spark, sf_dir, "documents"), held_out)
    return scored.withColumnRenamed("id", "doc_id")


@query
def op13_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of at most 2048; a digest stands for ids."""
    docs = table(spark, sf_dir, "documents")
    pieces = harmonic_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    digest = F.crc32("ids")
    unplaced = F.when(F.col("sequence_id").isNull(), F.col("ids"))
    first = written(pieces.withColumn("ids_crc32", digest).withColumn("ids", unplaced), "pieces")
    return settled(first).select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.coalesce("ids_crc32", digest).alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where the last words of every tenth text, by its id, repeat some of them."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    found = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = (
        docs.select("doc_id", "text", F.floor(hashed / 10).alias("g"), (hashed % 10).alias("h"))
        .withColumn("words", F.when(F.col("h") == 0, found))
        .withColumn("a", F.when(F.size("words") > 0, F.expr("g % size(words)")))
        .withColumn("p", F.expr("1 + (size(words) - a) div (3 + g % 8)"))
    )
    planted = F.expr("transform(words, (w, i) -> if(i < a, w, words[int(a + (i - a) % p)]))")
    return chosen.select("doc_id", F.coalesce(F.array_join(planted, " "), "text").alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in all documents, a tenth of them with repeats put in.

    A row without an id keeps its text as it is.
    """
    found = periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.array_max(
        F.transform(
            "runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"])
        )
    )
    listed = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by the hash of conversation and turn."""
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    text = F.coalesce("text", F.lit(" "))
    return (
        turns.withColumn("damage", F.crc32(named) % 20)
        .where("damage <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("damage") == 1, "")
            .when(F.col("damage") == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.when(F.col("damage") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
        )
    )


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults put into all conversations, and the cheapest repair of each."""
    turns = table(spark, sf_dir, "conversations")
    rows = written(distinct_turns(_damaged(turns), "conv_id", "turn", "role", "text"), "turns")
    reports = conversation_reports(repaired_parts(with_faults(rows)))
    found = turns.select("conv_id").distinct()
    for part in (turn_gaps(rows).withColumnRenamed("id", "gap_id"), reports):
        key = "gap_id" if "gap_id" in part.columns else "id"
        found = found.join(part, found["conv_id"].eqNullSafe(part[key]), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *(F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
