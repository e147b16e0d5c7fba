"""JSON messages without a declared schema: one merged over all of them, and columns by it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

# types as schema_of_variant_agg tells them; names that need it are in backticks
_TOKENS = re.compile(r"`(?:[^`]|``)*`|OBJECT(?=<)")


def json_value(value: Column | str) -> Column:
    """The message as a VARIANT; NULL if there is none or it is no JSON."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.try_parse_json(text)


def is_object(body: Column | str) -> Column:
    """Whether a VARIANT is a JSON object; false for NULL."""
    kind = F.schema_of_variant(body)
    return F.coalesce(kind.startswith("OBJECT"), F.lit(False))


def json_objects(messages: DataFrame) -> DataFrame:
    """Topic messages that are JSON objects, with the object in ``body`` in place of ``value``.

    Messages without a value are left out, and what is no object as well: ``not_objects``.
    """
    rest = [name for name in messages.columns if name != "value"]
    return messages.select(*rest, json_value("value").alias("body")).where(is_object("body"))


def not_objects(messages: DataFrame) -> DataFrame:
    """Topic messages with a value that is no JSON object, as they came."""
    return messages.where(F.col("value").isNotNull() & ~is_object(json_value("value")))


def merged_schema(objects: DataFrame, body: str = "body") -> StructType:
    """The fields of all objects, found in one pass with partial results per task.

    Numbers with a fraction are DOUBLE, as JSON has no decimals; longer whole numbers than
    BIGINT are DECIMAL. A field that is always null, or an array of nothing, is STRING. One that
    has values of several kinds, or objects without fields, stays VARIANT. No objects, no fields.
    """
    found = objects.agg(F.schema_of_variant_agg(body)).first()[0]
    if found is None or not found.startswith("OBJECT"):
        return StructType()
    kind = DataType.fromDDL(_TOKENS.sub(lambda m: "STRUCT" if m[0] == "OBJECT" else m[0], found))
    return _settled(kind) if len(kind.fields) else StructType()


def _settled(kind: DataType) -> DataType:
    if isinstance(kind, StructType):
        if not kind.fields:
            return VariantType()
        return StructType([StructField(f.name, _settled(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_settled(kind.elementType))
    if isinstance(kind, DecimalType) and kind.scale > 0:
        return DoubleType()
    return StringType() if isinstance(kind, NullType) else kind


def object_columns(
    objects: DataFrame, schema: StructType | None = None, body: str = "body"
) -> DataFrame:
    """The fields of each object as columns, under ``schema`` or else ``merged_schema``.

    Fields an object lacks are NULL. Names that differ by case only get a number behind.
    """
    schema = merged_schema(objects, body) if schema is None else schema
    if not schema.fields:
        return objects.select()
    unique = _unique_by_case(schema)
    # from VARIANT fields go by name, from struct to struct by place
    data = F.col(body).cast(schema).cast(unique)
    return objects.select(F.inline(F.array(data)))


def _unique_by_case(schema: DataType) -> DataType:
    if isinstance(schema, ArrayType):
        return ArrayType(_unique_by_case(schema.elementType))
    if not isinstance(schema, StructType):
        return schema
    taken = {field.name.lower() for field in schema.fields}
    seen: set[str] = set()
    fields = []
    for field in schema.fields:
        name, number = field.name, 1
        while name.lower() in seen or (name != field.name and name.lower() in taken):
            number += 1
            name = f"{field.name}_{number}"
        seen.add(name.lower())
        fields.append(StructField(name, _unique_by_case(field.dataType)))
    return StructType(fields)
