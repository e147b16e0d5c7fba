"""Rows to message payloads and back: JSON text, and the schema-id header of framed payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"

# The writer's default keeps milliseconds only.
_JSON_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def json_payload(*columns: str) -> Column:
    """The row as one JSON object in UTF-8, NULL fields written as ``null``."""
    row = F.struct(*(columns or ("*",)))
    return F.to_json(row, {"ignoreNullFields": "false", **_JSON_TIME}).cast("binary")


def from_json_payload(
    value: Column | str, schema: StructType, mode: str = "PERMISSIVE"
) -> Column:
    """The payload as a struct of ``schema``; a NULL payload gives a NULL struct.

    In FAILFAST mode a message that does not parse is an error. In PERMISSIVE mode the
    struct has one more field, ``_corrupt``, with the text of such a message; for a
    message whose fields are merely all null it is NULL.
    """
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    if mode == "FAILFAST":
        return F.from_json(text, schema, {"mode": mode, **_JSON_TIME})
    if mode != "PERMISSIVE":
        raise ValueError(f"unknown mode {mode}")
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **_JSON_TIME}
    return F.from_json(text, with_corrupt, options)


def parse_json_payloads(messages: DataFrame, schema: StructType) -> DataFrame:
    """The fields of each message's ``value``, with ``_corrupt`` to tell good from bad.

    Unlike a struct column, the output of a generator is not computed over again below
    a filter on it, so each message is parsed once however the result is split.
    """
    return messages.select(F.inline(F.array(from_json_payload("value", schema))))


def split_json_messages(
    messages: DataFrame, schema: StructType
) -> tuple[DataFrame, Column, DataFrame]:
    """Messages that parse (or have no value), their struct of ``schema``, and the other messages."""
    parsed = messages.withColumn("parsed", from_json_payload("value", schema))
    is_corrupt = F.coalesce(F.col("parsed").getField(CORRUPT).isNotNull(), F.lit(False))
    decoded = F.col("parsed").dropFields(CORRUPT)
    return parsed.where(~is_corrupt), decoded, parsed.where(is_corrupt).drop("parsed")


def framed(payload: Column, schema_id: int) -> Column:
    """Put the five header bytes before a payload: a zero byte and the id, big-endian."""
    return F.concat(F.unhex(F.lit(f"00{schema_id:08X}")), payload)


def unframed(value: Column | str) -> Column:
    """The payload without its five header bytes."""
    return F.substring(value, 6, 2**31 - 1)


def frame_schema_id(value: Column | str) -> Column:
    """The schema id in a framed payload's header."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
