"""Dialogues rendered once from the point of view of every participant."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from millrace.operators.numbering import in_chunks

_SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))
_RENDERED = StructType([StructField("rendered", StringType()), StructField("mask", _SPANS)])


def _escaped(text: str) -> str:
    """A text in which no mark of the format can be read."""
    return text.replace("<|", "<\\|")


def render(
    turns: Sequence[tuple[str | None, str | None]], perspective: str, system: Sequence[str]
) -> tuple[str, list[tuple[int, int]]]:
    """A dialogue as text, and the spans to learn from: what the assistant says, with its end."""
    parts, spans, at = [], [], 0
    for speaker, text in turns:
        mine = speaker == perspective
        if mine:
            head = "<|im_start|>assistant\n"
        elif speaker in system:
            head = "<|im_start|>system\n"
        else:
            name = "unknown" if speaker is None else " ".join(_escaped(speaker).split())
            head = f"<|im_start|>user name={name}\n"
        body = _escaped(text or "") + "<|im_end|>"
        if mine:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "\n"]
        at += len(head) + len(body) + 1
    return "".join(parts), spans


def perspectives(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
    system: Sequence[str] = ("system",),
    turns_per_part: int = 256,
) -> DataFrame:
    """Rows (conv_id, perspective, part, rendered, mask, split): each dialogue for each participant.

    The participant is the assistant, all others are users with their names, and ``system``
    speakers keep their role and have no view of their own. ``mask`` has the spans to learn
    from, in code points of ``rendered`` with the end exclusive. Turns come in order of their
    numbers, those without number first; a tie goes by speaker, then text. A turn repeated as
    a whole is rendered once. A null text is empty; a null speaker is a user named unknown,
    without a view; rows without conversation are left out. Numbers from one multiple
    of ``turns_per_part`` to the next make a part, those without number are in part 0. A part of
    more turns than that, for many have one number or none, comes in splits of so many,
    counted in order: so a conversation of any length is never in one task. A
    conversation has as many rows as participants times parts and splits.
    """
    said = (
        turns.select(
            F.col(conv_col).alias("conv_id"),
            F.col(turn_col).cast("long").alias("turn"),
            F.col(speaker_col).alias("speaker"),
            F.col(text_col).alias("text"),
        )
        .where(F.col("conv_id").isNotNull())
        .dropDuplicates()
    )
    part = F.floor(F.coalesce("turn", F.lit(0)) / turns_per_part).cast("long")
    order = ("turn", "speaker", "text")
    chunks = in_chunks(said.withColumn("part", part), turns_per_part, ("conv_id", "part"), order)
    parts = (
        chunks.groupBy("conv_id", "part", F.col("chunk").alias("split"))
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias("turns"))
    )
    speakers = (
        said.where(F.col("speaker").isNotNull() & ~F.col("speaker").isin(list(system)))
        .select("conv_id", F.col("speaker").alias("perspective"))
        .distinct()
    )
    fixed = tuple(system)

    @F.pandas_udf(_RENDERED)
    def rendered(dialogues: pd.Series, views: pd.Series) -> pd.DataFrame:
        rows = []
        for dialogue, view in zip(dialogues, views, strict=True):
            text, spans = render([(t["speaker"], t["text"]) for t in dialogue], view, fixed)
            rows.append((text, [{"start": start, "end": end} for start, end in spans]))
        return pd.DataFrame(rows, columns=["rendered", "mask"])

    return (
        parts.join(speakers, "conv_id")
        .withColumn("out", rendered("turns", "perspective"))
        .select("conv_id", "perspective", "part", "out.rendered", "out.mask", "split")
    )
