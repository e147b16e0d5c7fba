"""Groups of documents whose sets of word shingles are alike, by Jaccard similarity.

Two sets as alike as asked for must share enough of the first tokens, the prefix, under any
order of all tokens. Orders here put frequent tokens last and others by a hash, a different
one in each. Frequency comes from a sketch of fixed size that counts the shingles of all
documents. Pairs that share tokens of their first prefixes are found with an inverted index
and counted; too few shared ones rule a pair out, as do too few under any other order. Only
pairs that pass under all orders have their sets compared.

Documents with equal sets are one class and join once. Tokens counted as frequent can be
shared by very many classes, of which most pairs are linked through others anyway: these
are joined in two rounds. The first tries neighbours only. The second tries all pairs that are still
in different components, so no link that matters is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.blocks import BLOCK_SCHEMA, bucket_count, from_blocks, text_chunks, to_blocks
from millrace.llm.components import components
from millrace.llm.hashing import mix
from millrace.llm.shared import written
from millrace.llm.shingles import WordHashes, shingle_sets
from millrace.llm.word_ids import forget_words
from millrace.operators.numbering import free_names

#: One odd multiplier for each order of the tokens.
_ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
_SKETCH_BITS = 20
_SKETCH_PARTS = 64
_POSTING = np.dtype([("token", "u4"), ("cls", "u8"), ("size", "u4"), ("often", "u2")])
_PAIR = np.dtype(
    [("a", "u8"), ("b", "u8"), ("size_a", "u4"), ("size_b", "u4"), ("often", "u2"), ("n", "u4")]
)
_HELD = np.dtype([("token", "u4"), ("cls", "u8"), ("size", "u4")])
_MOST_OFTEN = 0xFFFF
_RARE, _OFTEN = 0, 1
#: Pairs that are held before they are added up, which takes several copies of them.
_PAIRS_AT_ONCE = 1_000_000


class Likeness:
    """Jaccard similarity of at least ``percent`` of a hundred."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def linked(self, shared, size_a, size_b):
        return 100 * shared >= self.percent * (size_a + size_b - shared)

    def overlap(self, size_a, size_b):
        """Least number of shared tokens."""
        return -(-self.percent * (size_a + size_b) // (100 + self.percent))

    def prefix(self, size):
        """Tokens of a set that hold at least one shared with any set as alike."""
        return size - -(-self.percent * size // 100) + 1

    def sizes(self, size_a, size_b):
        least, most = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
        return 100 * least >= self.percent * most

    def in_prefixes(self, size_a, size_b):
        """Least number of tokens shared by both prefixes.

        The set whose prefix ends first has all other shared tokens behind its prefix.
        """
        behind = np.maximum(size_a - self.prefix(size_a), size_b - self.prefix(size_b))
        return np.maximum(1, self.overlap(size_a, size_b) - behind)

    def prefix_of(self, size: str) -> Column:
        """``prefix`` of a column."""
        return F.col(size) - F.ceil(F.col(size) * self.percent / 100) + 1

    def in_prefixes_of(self, size_a: str, size_b: str) -> Column:
        """``in_prefixes`` of two columns."""
        both = F.col(size_a) + F.col(size_b)
        overlap = F.ceil(both * self.percent / (100 + self.percent))
        behind = F.greatest(
            *(F.col(size) - self.prefix_of(size) for size in (size_a, size_b))
        )
        return F.greatest(F.lit(1), overlap - behind)


def set_classes(text: np.ndarray, value: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and a 64-bit name of each set; equal sets have equal names, an empty one has 0."""
    size = np.bincount(text, minlength=count)
    name = np.zeros(count, np.uint64)
    filled = np.flatnonzero(size)
    if len(filled):
        starts = (np.cumsum(size) - size)[filled]
        name[filled] = mix(
            np.add.reduceat(mix(value), starts) ^ mix(size[filled].astype(np.uint64))
        ) | np.uint64(1)
    return size, name


def order_keys(value: np.ndarray, order: int, rank: np.ndarray) -> np.ndarray:
    """Where tokens stand in an order: by rank of frequency, then by the order's own hash."""
    often = rank[(value >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    own = mix(value * np.uint64(_ORDERS[order]))
    return often << np.uint64(56) | own >> np.uint64(8)


def set_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 75,
) -> DataFrame:
    """Rows (id, n_shingles, component_id, row_key, group), one for each row of ``docs``.

    ``component_id`` is the least id reachable over links, two rows being linked when their
    sets' Jaccard similarity is ``percent`` or more. Words are told apart without regard to
    the case of A-Z. A null or wordless text has an empty set, linked with nothing. Rows that
    are alike, also those repeated as a whole, are one group; a null id never names one
    unless all of its group are null. ``row_key`` is the hash of id and text, ``group`` a name
    that the rows of a component share, null for empty sets. Other columns are ignored.
    """
    alike = Likeness(percent)
    keyed = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"),
        F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("body"),
    )
    measured = _measured(keyed, width)
    sets = measured.where("part IS NULL").select("id", "row_key", "n_shingles", "cls")
    rank = _frequency_ranks(measured)
    shared = _shared_tokens(keyed, width, alike, rank)
    held = shared.where(F.col("kind") == _OFTEN).select("token", "cls", "n")
    own = Window.partitionBy("cls")
    often = written(
        held.withColumn("reach", F.count("*").over(own)).withColumn(
            "rank", F.row_number().over(own.orderBy("token"))
        ),
        "frequent",
    )
    near = _neighbours(often, alike)
    pairs = shared.where(F.col("kind") == _RARE).select("a", "b")
    tried = written(pairs.unionByName(near).distinct(), "pairs")
    links = _verified(keyed, sets, tried, width, alike, rank)
    first = components(links)
    rest = _across(often, first, alike).join(tried, ["a", "b"], "left_anti")
    more = _verified(keyed, sets, written(rest.distinct(), "pairs"), width, alike, rank)
    joined = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    labels = sets.where("n_shingles > 0").groupBy("cls").agg(F.min("id").alias("least"))
    grouped = labels.join(joined, F.col("cls") == F.col("node"), "left").select(
        "cls", "least", F.coalesce("component", "cls").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "component").select("cls", "component_id", "component")
    return sets.join(named, "cls", "left").select(
        "id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
        "row_key",
        F.col("component").alias("group"),
    )


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 75,
) -> DataFrame:
    """The rows of ``docs`` with the least id of their component, all columns kept.

    Of rows without id one stays if its whole component has none; of rows alike in id and
    text one stays. Rows with empty sets stay, however many.
    """
    found = set_components(docs, id_col, text_col, width, percent)
    first = F.min_by("row_key", F.struct(F.col("id").isNull(), "id", "row_key"))
    row_key, empty_name, own_name = free_names(docs.columns, "row_key", "empty", "own")
    chosen = (
        found.where("group IS NOT NULL").groupBy("group").agg(first.alias(row_key))
        .select(row_key, F.lit(False).alias(empty_name))
    )
    empty = found.where("group IS NULL").select(
        F.col("row_key").alias(row_key), F.lit(True).alias(empty_name)
    )
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    own = F.when(F.col(empty_name), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    return (
        docs.withColumn(row_key, key)
        .join(chosen.unionByName(empty.distinct()), row_key)
        .withColumn(own_name, own)
        .dropDuplicates([row_key, own_name])
        .select(*docs.columns)
    )


def _measured(keyed: DataFrame, width: int) -> DataFrame:
    """A row for each text with its set's size and class, and the tasks' parts of the sketch."""
    id_type = keyed.schema["id"].dataType.simpleString()

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        known = WordHashes()
        counts = np.zeros(1 << _SKETCH_BITS, np.int64)
        schema = None
        for batch in batches:
            sizes, names = [], []
            for low, high in text_chunks(batch["body"]):
                text, value = shingle_sets(batch["body"][low:high].to_pylist(), width, known)
                counts += np.bincount(
                    (value >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64),
                    minlength=len(counts),
                )
                size, name = set_classes(text, value, high - low)
                sizes.append(size)
                names.append(name)
            rows = batch.num_rows
            made = pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["row_key"],
                    pa.array(np.concatenate([*sizes, np.zeros(0, np.int64)]), pa.int64()),
                    pa.array(np.concatenate([*names, np.zeros(0, np.uint64)]).view(np.int64)),
                    pa.nulls(rows, pa.int32()),
                    pa.nulls(rows, pa.binary()),
                ],
                names=["id", "row_key", "n_shingles", "cls", "part", "counts"],
            )
            schema = made.schema
            yield made
        if schema is not None:
            nothing = [pa.nulls(_SKETCH_PARTS, field.type) for field in list(schema)[:4]]
            yield pa.RecordBatch.from_arrays(
                [
                    *nothing,
                    pa.array(range(_SKETCH_PARTS), pa.int32()),
                    pa.array(
                        [
                            zlib.compress(part.astype("<i4").tobytes(), 1)
                            for part in np.split(counts, _SKETCH_PARTS)
                        ],
                        pa.binary(),
                    ),
                ],
                schema=schema,
            )

    return written(
        keyed.mapInArrow(
            measure,
            f"id {id_type}, row_key bigint, n_shingles bigint, cls bigint, part int, counts binary",
        ),
        "sets",
    )


def _frequency_ranks(measured: DataFrame) -> np.ndarray:
    """How far each cell of the sketch stands out: 0 for most, one more for each doubling.

    The sketch has a fixed size, so its sum passes through the driver whatever the input.
    """

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(
                batch["part"].to_pylist(), batch["counts"].to_pylist(), strict=True
            ):
                found = np.frombuffer(zlib.decompress(counts), "<i4").astype(np.int64)
                sums[part] = sums[part] + found if part in sums else found
        for part, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                names=["part", "total"],
            )

    sums = (
        measured.where("part IS NOT NULL")
        .select("part", "counts")
        .repartition("part")
        .mapInArrow(add, "part int, total binary")
        .collect()
    )
    cells = 1 << _SKETCH_BITS
    counts = np.zeros(cells, np.int64)
    for row in sums:
        total = np.frombuffer(row["total"], np.int64)
        counts[row["part"] * len(total) : (row["part"] + 1) * len(total)] = total
    mean = counts.sum() / cells
    usual = mean + 8 * np.sqrt(mean) + 8
    over = np.log2(np.maximum(counts / usual, 0.5))
    return np.where(counts > usual, np.floor(over) + 1, 0).astype(np.uint8)


def _prefixes(
    text: np.ndarray, value: np.ndarray, size: np.ndarray, alike: Likeness, keys: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the prefixes: (text, token, key), by text and key."""
    order = np.lexsort((keys, text))
    place = np.arange(len(text)) - (np.cumsum(size) - size)[text]
    first = order[place < alike.prefix(size)[text]]
    return text[first], value[first], keys[first]


def _shared_tokens(
    keyed: DataFrame, width: int, alike: Likeness, rank: np.ndarray
) -> DataFrame:
    """Pairs of classes that may be linked by rare tokens, and who holds which frequent ones."""
    buckets = bucket_count(keyed.sparkSession)
    ranks = keyed.sparkSession.sparkContext.broadcast(rank)

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        known, seen = WordHashes(), set()
        for batch in batches:
            made, keys = [], []
            for low, high in text_chunks(batch["body"]):
                text, value = shingle_sets(batch["body"][low:high].to_pylist(), width, known)
                size, name = set_classes(text, value, high - low)
                new = np.zeros(high - low, bool)
                for index, cls in enumerate(name.tolist()):
                    if cls and cls not in seen:
                        seen.add(cls)
                        new[index] = True
                inside = new[text]
                text, value, size = text[inside], value[inside], np.where(new, size, 0)
                text, value, key = _prefixes(
                    text, value, size, alike, order_keys(value, 0, ranks.value)
                )
                often = key >> np.uint64(56) > 0
                many = np.bincount(text[often], minlength=high - low)
                postings = np.zeros(len(text), _POSTING)
                postings["token"] = value & np.uint64(0xFFFFFFFF)
                postings["cls"], postings["size"] = name[text], size[text]
                postings["often"] = np.minimum(many, _MOST_OFTEN)[text]
                yield from to_blocks(postings[often], value[often], buckets, _OFTEN)
                made.append(postings[~often])
                keys.append(value[~often])
            if made:
                yield from to_blocks(np.concatenate(made), np.concatenate(keys), buckets, _RARE)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = from_blocks(batches, {_RARE: _POSTING, _OFTEN: _POSTING})
        rare, starts, sizes = _by_token(found[_RARE])
        often, _, holders = _by_token(found[_OFTEN])
        # of a token in one class only nothing follows
        often = often[np.repeat(holders > 1, holders)]
        held = np.zeros(len(often), _HELD)
        for name in _HELD.names:
            held[name] = often[name]
        yield from to_blocks(held, mix(held["cls"]), buckets, _OFTEN)
        for pairs in _pairs(rare, starts, sizes, alike):
            yield from to_blocks(pairs, mix(pairs["a"] * np.uint64(3) + pairs["b"]), buckets, _RARE)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = from_blocks(batches, {_RARE: _PAIR, _OFTEN: _HELD})
        pairs = _summed(found[_RARE])
        needed = alike.in_prefixes(
            pairs["size_a"].astype(np.int64), pairs["size_b"].astype(np.int64)
        )
        often = pairs["often"].astype(np.int64)
        pairs = pairs[(pairs["n"] + often >= needed) | (often == _MOST_OFTEN)]
        yield _rows(_RARE, a=pairs["a"], b=pairs["b"])
        held = found[_OFTEN]
        yield _rows(_OFTEN, token=held["token"], cls=held["cls"], n=held["size"])

    return written(
        keyed.mapInArrow(post, BLOCK_SCHEMA)
        .repartition("bucket")
        .mapInArrow(meet, BLOCK_SCHEMA)
        .repartition("bucket")
        .mapInArrow(count, "kind int, " + ", ".join(f"{name} bigint" for name in _ROW)),
        "shared",
    )


_ROW = ("a", "b", "token", "cls", "n")


def _rows(kind: int, **columns: np.ndarray) -> pa.RecordBatch:
    """Rows of one kind, other columns null; names of classes as signed numbers."""
    count = len(next(iter(columns.values())))
    made = [pa.array(np.full(count, kind, np.int32))]
    for name in _ROW:
        if name in columns:
            values = np.ascontiguousarray(columns[name])
            signed = values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64)
            made.append(pa.array(signed))
        else:
            made.append(pa.nulls(count, pa.int64()))
    return pa.RecordBatch.from_arrays(made, names=["kind", *_ROW])


def _by_token(postings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct postings in order of tokens and classes; where each token starts, and how many it has."""
    postings = postings[np.lexsort((postings["cls"], postings["token"]))]
    token, cls = postings["token"], postings["cls"]
    new = np.ones(len(postings), bool)
    new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
    postings = postings[new]
    token = postings["token"]
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(postings)])
    return postings, starts, np.diff(starts, append=len(postings))


def _pairs(
    postings: np.ndarray, starts: np.ndarray, sizes: np.ndarray, alike: Likeness
) -> Iterator[np.ndarray]:
    """Pairs of classes with the number of rare tokens that they share in a bucket."""
    held, count = [], 0
    for size in np.unique(sizes[sizes > 1]):
        at = starts[sizes == size]
        left, right = np.triu_indices(size, 1)
        step = max(1, 1_000_000 // len(left))
        for low in range(0, len(at), step):
            rows = at[low : low + step, None]
            one, two = postings[(rows + left).ravel()], postings[(rows + right).ravel()]
            near = alike.sizes(one["size"].astype(np.int64), two["size"].astype(np.int64))
            near &= one["cls"] != two["cls"]
            one, two = one[near], two[near]
            swap = one["cls"] > two["cls"]
            pairs = np.zeros(len(one), _PAIR)
            pairs["a"] = np.where(swap, two["cls"], one["cls"])
            pairs["b"] = np.where(swap, one["cls"], two["cls"])
            pairs["size_a"] = np.where(swap, two["size"], one["size"])
            pairs["size_b"] = np.where(swap, one["size"], two["size"])
            pairs["often"] = np.minimum(one["often"], two["often"])
            pairs["n"] = 1
            held.append(pairs)
            count += len(pairs)
            if count >= _PAIRS_AT_ONCE:
                yield _summed(np.concatenate(held))
                held, count = [], 0
    if held:
        yield _summed(np.concatenate(held))


def _summed(pairs: np.ndarray) -> np.ndarray:
    """One record for each pair, its counts added up."""
    if not len(pairs):
        return pairs
    pairs = pairs[np.lexsort((pairs["b"], pairs["a"]))]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs["a"][1:] != pairs["a"][:-1]) | (pairs["b"][1:] != pairs["b"][:-1])
    first = np.flatnonzero(new)
    total = np.add.reduceat(pairs["n"], first)
    pairs = pairs[first]
    pairs["n"] = total
    return pairs


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _neighbours(often: DataFrame, alike: Likeness, centres: int = 3) -> DataFrame:
    """For each frequent token its classes paired with the next one, and with its centres.

    Centres are the classes of whose prefix the most tokens are frequent, as an original's
    are among its copies. Tokens are dealt to parts by class, so that none is one task's alone;
    the centres are the best of the parts' best.
    """
    share = F.col("reach") / alike.prefix_of("n")
    dealt = often.withColumn("slot", F.pmod(F.hash("cls"), F.lit(64))).withColumn("share", share)
    in_slot = dealt.groupBy("token", "slot").agg(
        F.sort_array(F.collect_set("cls")).alias("found"),
        F.slice(
            F.sort_array(F.collect_list(F.struct("share", "cls")), asc=False), 1, centres
        ).alias("best"),
    )
    of_token = in_slot.groupBy("token").agg(
        F.slice(
            F.sort_array(F.flatten(F.collect_list("best")), asc=False), 1, centres
        ).alias("best")
    )
    next_one = in_slot.where(F.size("found") > 1).select(
        F.explode(
            F.arrays_zip(
                F.slice("found", F.lit(1), F.size("found") - 1).alias("a"),
                F.slice("found", F.lit(2), F.size("found") - 1).alias("b"),
            )
        ).alias("pair")
    )
    to_centre = (
        in_slot.select("token", F.explode("found").alias("a"))
        .join(of_token, "token")
        .select("a", F.explode("best.cls").alias("b"))
    )
    return (
        next_one.select("pair.a", "pair.b")
        .unionByName(to_centre)
        .where("a != b")
        .transform(_ordered)
    )


def _across(often: DataFrame, known: DataFrame, alike: Likeness) -> DataFrame:
    """Pairs of classes of one frequent token that are in different components so far.

    ``reach`` counts the frequent tokens of a class's prefix. Pairs that share a rare token
    were found by it, so that others share no more than the lesser reach; for copies that
    strayed too far from an original that is too little for any set of about their size.
    The first token that a pair shares, by ``rank`` in each, must leave enough after it.
    """
    placed = written(
        often.join(known, F.col("cls") == F.col("node"), "left").select(
            "token", "cls", "n", (F.col("reach") - F.col("rank") + 1).alias("left"), F.coalesce("component", "cls").alias("component")
        ),
        "placed",
    )
    open_tokens = (
        placed.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("token")
    )
    left = placed.join(open_tokens, "token")
    right = left.select(
        "token",
        F.col("cls").alias("b"),
        F.col("component").alias("other"),
        F.col("n").alias("n_b"),
        F.col("left").alias("left_b"),
    )
    near = (
        (F.col("component") < F.col("other"))
        & (F.least("left", "left_b") >= alike.in_prefixes_of("n", "n_b"))
        & (100 * F.least("n", "n_b") >= alike.percent * F.greatest("n", "n_b"))
    )
    return (
        left.withColumnRenamed("cls", "a")
        .join(right, (left["token"] == right["token"]) & near)
        .select("a", "b")
        .transform(_ordered)
    )


def _verified(
    keyed: DataFrame,
    sets: DataFrame,
    pairs: DataFrame,
    width: int,
    alike: Likeness,
    rank: np.ndarray,
) -> DataFrame:
    """The pairs whose prefixes share enough under every order and whose sets are alike."""
    spark = keyed.sparkSession
    ranks = spark.sparkContext.broadcast(rank)
    slot = F.pmod(F.hash("b"), F.lit(8))
    placed = pairs.withColumn("bucket", F.hash("a", slot))
    wanted = (
        placed.select(F.col("a").alias("cls"), "bucket")
        .unionByName(placed.select(F.col("b").alias("cls"), "bucket"))
        .distinct()
    )
    holders = sets.groupBy("cls").agg(F.min("row_key").alias("row_key"))
    texts = (
        wanted.join(holders, "cls")
        .join(keyed.select("row_key", "body").dropDuplicates(["row_key"]), "row_key")
        .select("bucket", F.col("cls").alias("a"), F.lit(None).cast("bigint").alias("b"), "body")
    )
    asked = placed.select("bucket", "a", "b", F.lit(None).cast("binary").alias("body"))

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        found: dict[int, np.ndarray] = {}
        prefixes: dict[tuple[int, int], np.ndarray] = {}
        waiting: list[tuple[int, int]] = []
        for batch in batches:
            is_text = np.asarray(batch["b"].is_null())
            waiting += zip(
                batch["a"].filter(pa.array(~is_text)).to_pylist(),
                batch["b"].filter(pa.array(~is_text)).to_pylist(),
                strict=True,
            )
            names = np.asarray(batch["a"])[is_text]
            bodies = batch["body"].filter(pa.array(is_text))
            for low, high in text_chunks(bodies):
                text, value = shingle_sets(bodies[low:high].to_pylist(), width, known)
                edges = np.searchsorted(text, np.arange(high - low + 1))
                for index in range(high - low):
                    found[int(names[low + index])] = value[edges[index] : edges[index + 1]]

        def prefix(name: int, order: int) -> np.ndarray:
            if (name, order) not in prefixes:
                keys = np.sort(order_keys(found[name], order, ranks.value))
                prefixes[name, order] = keys[: alike.prefix(len(keys))]
            return prefixes[name, order]

        links = []
        for a, b in waiting:
            size_a, size_b = len(found[a]), len(found[b])
            if not alike.sizes(size_a, size_b):
                continue
            needed = alike.in_prefixes(size_a, size_b)
            if all(
                _common(prefix(a, order), prefix(b, order)) >= needed
                for order in range(len(_ORDERS))
            ) and alike.linked(_common(found[a], found[b]), size_a, size_b):
                links.append((a, b))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([a for a, _ in links], pa.int64()),
                pa.array([b for _, b in links], pa.int64()),
            ],
            names=["a", "b"],
        )

    return written(
        texts.unionByName(asked).repartition("bucket").mapInArrow(verify, "a bigint, b bigint"),
        "links",
    )


def _common(one: np.ndarray, two: np.ndarray) -> int:
    """Values that two sorted arrays of distinct values share."""
    if len(one) > len(two):
        one, two = two, one
    at = np.searchsorted(two, one)
    return int((two[np.minimum(at, len(two) - 1)] == one).sum()) if len(two) else 0
