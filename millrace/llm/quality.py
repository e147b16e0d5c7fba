"""Quality rules whose cutoffs come from quantile sketches of the texts' own groups.

A sketch counts values by buckets of a binary scale with 32 steps per doubling, so a quantile
is known to one part in 32. Counts add up: they are gathered map-side, per language and
source, and a group too small to tell its own quantiles uses those of its language, or of all
texts, whose sketches are sums of the same counts.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.shared import written
from millrace.llm.word_ids import forget_words
from millrace.llm.words import words
from millrace.operators.numbering import free_names

#: Counts of a text, all long.
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
)
_COUNTS_TYPE = StructType([StructField(name, LongType()) for name in COUNTS])
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"
_WINDOW = 8
#: Ratios are held as whole millionths.
_ONE = 1_000_000

#: Ratio name, numerator, denominator, and the least distance of a cutoff from the median.
RATIOS = (
    ("symbol_share", "n_symbols", "word_chars", 20_000),
    ("word_length", "word_chars", "n_words", 1_500_000),
    ("dup_line_share", "n_dup_lines", "n_lines", 500_000),
    ("repeat_share", "n_repeat_words", "n_words", 300_000),
)


def _counts(body: bytes) -> tuple[int, ...]:
    found = words(body)
    n_words = len(found)
    bare = body.translate(None, _SPACES)
    # bytes that go on with a character of more than one byte are no code points
    chars = len(bare.decode("utf-8", "surrogatepass"))
    n_symbols = len(body) - len(body.translate(None, _SYMBOLS))
    lines, seen, dup = 0, set(), 0
    for line in body.split(b"\n"):
        if line.strip(_SPACES):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeated = 0
    windows = list(zip(*(found[start:] for start in range(_WINDOW)), strict=False))
    if len(set(windows)) < len(windows):
        times: dict = {}
        for window in windows:
            times[window] = times.get(window, 0) + 1
        reach = 0
        for start, window in enumerate(windows):
            if times[window] > 1:
                repeated += start + _WINDOW - max(start, reach)
                reach = start + _WINDOW
    return n_words, chars, n_symbols, dup, repeated, lines


@F.pandas_udf(_COUNTS_TYPE)
def text_counts(texts: pd.Series) -> pd.DataFrame:
    """Counts of each text; those of a null are 0."""
    forget_words()
    return pd.DataFrame(
        [_counts((text or "").encode("utf-8", "surrogatepass")) for text in texts],
        columns=list(COUNTS),
        dtype="int64",
    )


def base_failed(counts: Column) -> Column:
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return (counts["n_words"] < 20) | (
        100 * counts["n_repeat_words"] > 30 * counts["n_words"]
    )


def _millionths(counts: Column, top: str, bottom: str) -> Column:
    ratio = F.call_function("div", counts[top] * _ONE, F.greatest(counts[bottom], F.lit(1)))
    return ratio.cast("long")


def _bucket(value: Column) -> Column:
    """A bucket of the binary scale; larger values never have smaller buckets."""
    doublings = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (doublings * 32 + F.call_function("shiftright", value, doublings)).cast("long")


def _bucket_start(bucket: Column) -> Column:
    doublings = F.greatest(F.floor(bucket / 32) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", bucket - 32 * doublings, doublings)


def sketches(measured: DataFrame, counts: str, by: Sequence[str]) -> DataFrame:
    """Rows (by..., ratio, bucket, n): the sketch of every ratio and group, texts without words left out."""
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("ratio"),
                _bucket(_millionths(F.col(counts), top, bottom)).alias("bucket"),
            )
            for name, top, bottom, _ in RATIOS
        )
    )
    return (
        measured.where(F.col(f"{counts}.n_words") > 0)
        .select(*(F.col(name) for name in by), F.explode(entries).alias("entry"))
        .groupBy(*by, "entry.ratio", "entry.bucket")
        .agg(F.count("*").alias("n"))
    )


def cutoffs(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows (by..., total, limits): for each ratio the 10 %, 50 % and 90 % points of a group."""
    group = [*by, "ratio"]
    running = Window.partitionBy(*group).orderBy("bucket")
    whole = Window.partitionBy(*group)
    placed = sketch.groupBy(*group, "bucket").agg(F.sum("n").alias("n")).select(
        *group,
        "bucket",
        F.sum("n").over(running).alias("upto"),
        F.sum("n").over(whole).alias("total"),
    )

    def point(percent: int) -> Column:
        reached = F.col("upto") * 100 >= F.col("total") * percent
        return _bucket_start(F.min(F.when(reached, F.col("bucket"))))

    points = placed.groupBy(*group, "total").agg(
        point(10).alias("low"), point(50).alias("mid"), point(90).alias("high")
    )
    return points.groupBy(*by).agg(
        F.max("total").alias("total"),
        F.map_from_entries(
            F.collect_list(F.struct("ratio", F.struct("low", "mid", "high")))
        ).alias("limits"),
    )


def with_verdicts(
    docs: DataFrame,
    counts: str,
    verdict: str,
    lang_col: str = "lang",
    source_col: str = "source",
    least_rows: int = 100,
    reach: int = 8,
) -> DataFrame:
    """Adds a boolean column: whether a text passes the fixed rules and its group's cutoffs.

    ``counts`` names a column made by ``text_counts``; it is read twice, so the rows should
    come from a written table. A ratio is out of bounds when it is further from its group's
    median than ``reach`` times the distance of the 10 % point (for ratios too low) or the
    lesser of both points' distances (for ratios too high), and than a least distance. The
    nearer point is used upward because junk in a bad source moves the upper one. A null
    language or source is a group like any other. Groups of fewer than ``least_rows`` texts
    use the cutoffs of their language, or else those of all texts. Repeated rows count each,
    and a long text is counted whole. A column named like the verdict is replaced.
    """
    lang, source = free_names(docs.columns, "quality_lang", "quality_source")
    kept = [name for name in docs.columns if name.lower() != verdict.lower()]
    keyed = docs.withColumns({lang: F.col(lang_col), source: F.col(source_col)})
    sketch = written(sketches(keyed, counts, (lang, source)), "sketches")
    tables = [
        (cutoffs(sketch, by), by) for by in ((lang, source), (lang,), ())
    ]
    joined, picks = keyed, []
    for level, (limits, by) in enumerate(tables):
        total, found = free_names(
            [*joined.columns, f"{lang}{level}", f"{source}{level}"], "quality_total", "quality_limits"
        )
        named = limits.select(
            *(F.col(name).alias(f"{name}{level}") for name in by),
            F.col("total").alias(total),
            F.col("limits").alias(found),
        )
        matches = [keyed[name].eqNullSafe(named[f"{name}{level}"]) for name in by]
        if by:
            condition = matches[0] if len(matches) == 1 else matches[0] & matches[1]
            joined = joined.join(named, condition, "left")
        else:
            # one row at most
            joined = joined.join(F.broadcast(named), F.lit(True), "left")
        last = level == len(tables) - 1
        picks.append(
            F.col(found) if last else F.when(F.col(total) >= least_rows, F.col(found))
        )
    limits = F.coalesce(*picks)
    fine = ~base_failed(F.col(counts))
    for name, top, bottom, least in RATIOS:
        value = _millionths(F.col(counts), top, bottom)
        low, mid, high = (limits[name][point] for point in ("low", "mid", "high"))
        down = F.greatest((mid - low) * reach, F.lit(least))
        up = F.greatest(F.least(mid - low, high - mid) * reach, F.lit(least))
        fine &= value.between(mid - down, mid + up)
    return joined.select(
        *(F.col(f"`{name}`") for name in kept), F.coalesce(fine, F.lit(False)).alias(verdict)
    )
