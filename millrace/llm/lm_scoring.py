"""Scores of texts by a context-tree model and by word counts, both learned from part of them.

Counts of byte runs are summed across tasks and make the context trees (``context_trees``). A
task weighs the subtrees of some pairs of last bytes; only contexts of a byte or none go to all
tasks. Neither runs nor words are bounded in number: the distinct ones of each slice of the
input go to the task that has a run's score or a word's total, and what they ask for comes back
to the task that scores the slice, so no task needs more than its slices' runs and words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import BLOCK_SCHEMA, bucket_count, from_blocks, text_chunks, to_blocks
from millrace.llm.context_trees import (
    ContextTrees,
    RunScores,
    Top,
    counted,
    levels_of,
    runs,
    subtree_sums,
    text_scores,
)
from millrace.llm.hashing import mix
from millrace.llm.shared import written
from millrace.llm.shingles import WordHashes
from millrace.llm.words import LOWER

_WORD = np.dtype([("word", "u8"), ("slice", "i8"), ("count", "i8")])
#: White space is in no word, so this names the end of a text.
_END = b"\n"
#: Slices of one part of a file, to keep the texts of a slice few.
_CUTS = 2
#: Runs that a task holds before it puts equal ones together.
_HELD = 1_000_000
#: Runs of small subtrees that are weighed together.
_TOGETHER = 1 << 16


def _slice(id_col: str) -> Column:
    """A name for the rows of one part of a file, or of rows whose ids hash alike."""
    name = F.input_file_name()
    cut = F.pmod(F.xxhash64(F.col(id_col)), F.lit(_CUTS))
    return F.when(
        name != "", F.xxhash64(name, F.input_file_block_start(), cut)
    ).otherwise(F.xxhash64(F.pmod(F.xxhash64(F.col(id_col)), F.lit(4096))))


def scores(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = 4,
) -> DataFrame:
    """Rows (id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    ``held_out`` tells the rows not to learn from; a null counts as false. A-Z are read as
    a-z, a null text as empty. Tokens are words and one end for each text. ``score`` is the
    log10 probability of the text and its end under the context trees of ``depth`` bytes, of all
    runs there are; ``bits_per_byte`` is that as a code length. ``base_score`` adds log10((c+1)/(N+V+1)) over the tokens, c
    being a token's count, N all and V the distinct ones of the rows learned from. Each row of
    ``docs`` has its own, repeated ones too. Without rows to learn from all chances are even.
    """
    keyed = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        _slice(id_col).alias("slice"),
        F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("body"),
    )
    spark = docs.sparkSession
    buckets = bucket_count(spark)
    answers = _word_totals(keyed, buckets)
    run_answers = _run_answers(keyed, _run_scores(_counted_runs(keyed, depth), depth), depth, buckets)
    sums = answers.where("kind = 1").agg(F.sum("distinct"), F.sum("total")).first()
    distinct, total = (int(value or 0) for value in sums)
    return _scored(keyed, answers.unionByName(run_answers, True), depth, distinct, total)


def _lowered(body: bytes) -> bytes:
    return body.translate(LOWER)


def _counted_runs(keyed: DataFrame, depth: int) -> DataFrame:
    """Rows (code, n) of all runs, with how often the rows to learn from have each, maybe never."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, held = [], [], 0
        for batch in batches:
            out = np.asarray(batch["held_out"].cast("int8"))
            for low, high in text_chunks(batch["body"], 1 << 19):
                bodies = [_lowered(body) for body in batch["body"][low:high].to_pylist()]
                for held_out in (0, 1):
                    rows = np.flatnonzero(out[low:high] == held_out)
                    if not len(rows):
                        continue
                    code, number = np.unique(
                        runs([bodies[row] for row in rows], depth)[0], return_counts=True
                    )
                    codes.append(code)
                    counts.append(number * (1 - held_out))
                    held += len(code)
                if held > _HELD:
                    code, number = counted(codes, counts)
                    codes, counts, held = [code], [number], len(code)
                    if held > _HELD // 2:
                        yield _run_batch(code, number)
                        codes, counts, held = [], [], 0
        if codes:
            yield _run_batch(*counted(codes, counts))

    found = (
        keyed.select("held_out", "body")
        .mapInArrow(count, "code bigint, n bigint")
        .groupBy("code")
        .agg(F.sum("n").alias("n"))
    )
    return written(found, "runs")


def _run_batch(code: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(code), pa.array(number)], names=["code", "n"])


def _subtrees(
    batches: Iterable[pa.RecordBatch], last: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs in order and counts of a task's subtrees, small ones together."""
    parts = [(np.asarray(batch["code"]), np.asarray(batch["n"])) for batch in batches]
    if not parts:
        return
    code, count = (np.concatenate(column) for column in zip(*parts, strict=True))
    order = np.lexsort((code, code >> 8 & last))
    code, count = code[order], count[order]
    edges = np.flatnonzero(np.diff(code >> 8 & last, prepend=-1, append=-1))
    low = 0
    for edge, after in zip(edges[1:], [*edges[2:], None], strict=True):
        if after is None or after - low > _TOGETHER:
            by_code = np.argsort(code[low:edge])
            yield code[low:edge][by_code], count[low:edge][by_code]
            low = edge


def _run_scores(found: DataFrame, depth: int) -> DataFrame:
    """Rows (code, score) of all runs: log10 probability of the last byte.

    A subtree has all contexts that end in the same two bytes, so it has at most so many runs
    as there are of three bytes.
    """
    first = min(2, depth)
    last = (1 << 8 * first) - 1
    dealt = found.withColumn(
        "last", F.shiftright("code", 8).bitwiseAND(F.lit(last).cast("long"))
    ).repartition("last")

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, count in _subtrees(batches, last):
            seen = count > 0
            levels = levels_of(code[seen], count[seen], first, depth)
            for bit, (key, zeros, ones, weighted) in enumerate(subtree_sums(levels, first)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(key), bit, np.int32)),
                        pa.array(key & ((1 << 8 * (first - 1) + bit) - 1)),
                        pa.array(zeros.astype(np.int64)),
                        pa.array(ones.astype(np.int64)),
                        pa.array(weighted),
                    ],
                    names=["bit", "key", "zeros", "ones", "weighted"],
                )

    top = None
    if first:
        # at most 256 each, summed in order so that every run gives the same
        product = F.aggregate(
            F.array_sort(F.collect_list("weighted")), F.lit(0.0), lambda total, one: total + one
        )
        sums = (
            dealt.mapInArrow(
                weigh, "bit int, key bigint, zeros bigint, ones bigint, weighted double"
            )
            .groupBy("bit", "key")
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), product.alias("product"))
            .toArrow()
            .sort_by([("bit", "ascending"), ("key", "ascending")])
        )
        columns = [np.asarray(sums[name]) for name in ("key", "zeros", "ones", "product")]
        bits = np.asarray(sums["bit"])
        top = Top([tuple(column[bits == bit] for column in columns) for bit in range(8)], first)
    shared = found.sparkSession.sparkContext.broadcast(top)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, count in _subtrees(batches, last):
            seen = count > 0
            trees = ContextTrees(levels_of(code[seen], count[seen], first, depth), shared.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(code), pa.array(trees.log10(code))], names=["code", "score"]
            )

    return dealt.mapInArrow(score, "code bigint, score double")


def _run_answers(keyed: DataFrame, scored: DataFrame, depth: int, buckets: int) -> DataFrame:
    """Rows of kind 2 with runs' scores for each slice."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            slices = np.asarray(batch["slice"])
            for low, high in text_chunks(batch["body"], 1 << 19):
                bodies = [_lowered(body) for body in batch["body"][low:high].to_pylist()]
                for name in np.unique(slices[low:high]).tolist():
                    rows = np.flatnonzero(slices[low:high] == name)
                    code = np.unique(runs([bodies[row] for row in rows], depth)[0])
                    held.setdefault(name, []).append(code)
                    size += len(code)
                if size > _HELD:
                    held = {name: [np.unique(np.concatenate(p))] for name, p in held.items()}
                    size = sum(len(code) for (code,) in held.values())
                    if size > _HELD // 2:
                        yield from _asked_runs(held, buckets)
                        held, size = {}, 0
        yield from _asked_runs(held, buckets)

    def offer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offered = np.zeros(len(batch["code"]), _RUN_SCORE)
            offered["code"], offered["score"] = np.asarray(batch["code"]), np.asarray(batch["score"])
            yield from to_blocks(offered, mix(offered["code"].astype(np.uint64)), buckets, 1)

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = from_blocks(batches, {0: _RUN, 1: _RUN_SCORE})
        asked, offered = blocks[0], np.sort(blocks[1], order="code")
        asked = asked[np.argsort(asked["slice"], kind="stable")]
        back = offered[np.searchsorted(offered["code"], asked["code"])]
        names, first = np.unique(asked["slice"], return_index=True)
        edges = np.append(first, len(asked))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([2] * len(names), pa.int32()),
                pa.array(names),
                pa.array(
                    [back[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)],
                    pa.binary(),
                ),
            ],
            names=["kind", "slice", "payload"],
        )

    asks = keyed.select("slice", "body").mapInArrow(ask, BLOCK_SCHEMA)
    return written(
        asks.unionByName(scored.mapInArrow(offer, BLOCK_SCHEMA))
        .repartition("bucket")
        .mapInArrow(answer, "kind int, slice bigint, payload binary"),
        "run-scores",
    )


_RUN = np.dtype([("code", "i8"), ("slice", "i8")])
_RUN_SCORE = np.dtype([("code", "i8"), ("score", "f4")])


def _asked_runs(held: dict[int, list], buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct runs of each slice as blocks."""
    for name, parts in held.items():
        code = np.unique(np.concatenate(parts))
        asked = np.zeros(len(code), _RUN)
        asked["code"], asked["slice"] = code, name
        yield from to_blocks(asked, mix(code.astype(np.uint64)), buckets)


def _word_hashes(
    bodies: list[bytes], known: WordHashes
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of texts, laid end to end, and how many each has."""
    known.trim()
    lists = [_lowered(body).split() for body in bodies]
    sizes = np.array([len(found) + 1 for found in lists], np.int64)
    end = known[_END]
    hashes = np.empty(int(sizes.sum()), np.uint64)
    at = 0
    for found in lists:
        hashes[at : at + len(found)] = [known[word] for word in found]
        hashes[at + len(found)] = end
        at += len(found) + 1
    return hashes, sizes


def _word_totals(keyed: DataFrame, buckets: int) -> DataFrame:
    """Rows of kind 0 with words' totals for each slice, and of kind 1 with sums over words."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            slices, out = np.asarray(batch["slice"]), np.asarray(batch["held_out"].cast("int8"))
            for low, high in text_chunks(batch["body"]):
                hashes, sizes = _word_hashes(batch["body"][low:high].to_pylist(), known)
                token_slice = np.repeat(slices[low:high], sizes)
                learned = np.repeat(out[low:high] == 0, sizes)
                for name in np.unique(slices[low:high]).tolist():
                    mine = token_slice == name
                    word, at = np.unique(hashes[mine], return_inverse=True)
                    number = np.bincount(at, learned[mine], len(word)).astype(np.int64)
                    held.setdefault(name, []).append((word, number))
                    size += len(word)
            if size > 8_000_000:
                yield from _asked(held, buckets)
                held, size = {}, 0
        yield from _asked(held, buckets)

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = from_blocks(batches, {0: _WORD})[0]
        word, at = np.unique(asked["word"], return_inverse=True)
        total = np.bincount(at, asked["count"], len(word)).astype(np.int64)
        back = np.zeros(len(asked), _WORD)
        back["word"], back["slice"], back["count"] = asked["word"], asked["slice"], total[at]
        back = back[np.argsort(back["slice"], kind="stable")]
        first = np.flatnonzero(np.diff(back["slice"], prepend=0) != 0)
        if len(back) and back["slice"][0] == 0:
            first = np.append(0, first)
        edges = np.append(first, len(back))
        payloads = [
            back[["word", "count"]][a:b].astype(_TOTAL).tobytes()
            for a, b in zip(edges[:-1], edges[1:], strict=True)
        ]
        count = len(payloads) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([0] * (count - 1) + [1], pa.int32()),
                pa.array([*back["slice"][first].tolist(), None], pa.int64()),
                pa.array([*payloads, None], pa.binary()),
                pa.array([None] * (count - 1) + [int((total > 0).sum())], pa.int64()),
                pa.array([None] * (count - 1) + [int(total.sum())], pa.int64()),
            ],
            names=["kind", "slice", "payload", "distinct", "total"],
        )

    return written(
        keyed.select("held_out", "slice", "body")
        .mapInArrow(ask, BLOCK_SCHEMA)
        .repartition("bucket")
        .mapInArrow(
            answer, "kind int, slice bigint, payload binary, distinct bigint, total bigint"
        ),
        "word-totals",
    )


_TOTAL = np.dtype([("word", "u8"), ("count", "i8")])


def _asked(held: dict[int, list], buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct words of each slice as blocks."""
    for name, parts in held.items():
        word, at = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        asked = np.zeros(len(word), _WORD)
        asked["word"], asked["slice"] = word, name
        asked["count"] = np.bincount(at, np.concatenate([n for _, n in parts]), len(word))
        yield from to_blocks(asked, mix(word), buckets)


def _scored(
    keyed: DataFrame, answers: DataFrame, depth: int, distinct: int, total: int
) -> DataFrame:
    id_type = keyed.schema["id"].dataType.simpleString()
    spread = np.log10(float(total + distinct + 1))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, totals, known_runs = [], {}, [np.zeros(0, _RUN_SCORE)]
        for batch in batches:
            for kind, name, payload in zip(
                batch["kind"].to_pylist(), batch["slice"].to_pylist(), batch["payload"], strict=True
            ):
                if kind == 2:
                    known_runs.append(np.frombuffer(payload.as_buffer(), _RUN_SCORE))
                elif kind == 0:
                    totals.setdefault(name, []).append(np.frombuffer(payload.as_buffer(), _TOTAL))
            is_text = batch["body"].is_valid()
            texts.append(batch.filter(is_text).select(["id", "held_out", "slice", "body"]))
        sorted_totals = {}
        for name, parts in totals.items():
            found = np.concatenate(parts)
            sorted_totals[name] = found[np.argsort(found["word"])]
        totals.clear()
        scored = np.concatenate(known_runs)
        known_runs.clear()
        run_scores = RunScores(scored["code"].copy(), scored["score"].copy(), depth)
        del scored
        known = WordHashes()
        for batch in texts:
            slices = np.asarray(batch["slice"])
            for low, high in text_chunks(batch["body"]):
                bodies = batch["body"][low:high].to_pylist()
                hashes, sizes = _word_hashes(bodies, known)
                token_slice = np.repeat(slices[low:high], sizes)
                count = np.zeros(len(hashes), np.int64)
                for name in np.unique(slices[low:high]).tolist():
                    mine = token_slice == name
                    found = sorted_totals[name]
                    count[mine] = found["count"][np.searchsorted(found["word"], hashes[mine])]
                first = np.cumsum(sizes) - sizes
                base = np.add.reduceat(np.log10(count + 1.0) - spread, first)
                seen = np.add.reduceat((count > 0).astype(np.int64), first)
                lowered = [_lowered(body) for body in bodies]
                best = np.array(list(text_scores(run_scores, lowered)))
                lengths = np.array([len(body) for body in bodies])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"][low:high],
                        batch["held_out"][low:high],
                        pa.array(sizes),
                        pa.array(seen),
                        pa.array(np.full(high - low, total, np.int64)),
                        pa.array(base),
                        pa.array(best),
                        pa.array(-best / np.log10(2) / np.maximum(lengths, 1)),
                    ],
                    names=[
                        "id",
                        "held_out",
                        "n_tokens",
                        "n_known",
                        "train_tokens",
                        "base_score",
                        "score",
                        "bits_per_byte",
                    ],
                )

    nothing = F.lit(None)
    return (
        keyed.withColumns({"kind": nothing.cast("int"), "payload": nothing.cast("binary")})
        .unionByName(
            answers.where("kind IN (0, 2)").select(
                nothing.cast(id_type).alias("id"),
                nothing.cast("boolean").alias("held_out"),
                "slice",
                nothing.cast("binary").alias("body"),
                "kind",
                "payload",
            )
        )
        .repartition("slice")
        .mapInArrow(
            score,
            f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, "
            "train_tokens bigint, base_score double, score double, bits_per_byte double",
        )
    )
