"""Avro payload columns for flat records of long, double and string fields.

Where the session has Spark's Avro package its own functions do the work. Elsewhere each
Arrow batch is coded column by column: a loop over fields, never over rows.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.avro import functions as spark_avro
from pyspark.sql.types import StructType

from millrace.functions import avro_batch
from millrace.schemas import SPARK_TYPES

# Ship the batch code with the function, so workers need no installed package.
cloudpickle.register_pickle_by_value(avro_batch)


def has_spark_avro() -> bool:
    """Whether the active session's JVM has Spark's Avro package."""
    jvm = SparkSession.active()._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    name = "org/apache/spark/sql/avro/AvroDataToCatalyst.class"
    return loader.getResource(name) is not None


def _declaration(schema: str | dict) -> str:
    return schema if isinstance(schema, str) else json.dumps(schema)


def parse_record(schema: str | dict) -> list[avro_batch.Field]:
    """The fields of an Avro record declaration."""
    record = json.loads(schema) if isinstance(schema, str) else schema
    if record.get("type") != "record":
        raise ValueError("only Avro records are supported")
    fields = []
    for declared in record["fields"]:
        kind, null_branch = declared["type"], None
        if isinstance(kind, list):
            if len(kind) != 2 or "null" not in kind:
                raise ValueError(f"{declared['name']}: only unions of null and one type")
            null_branch = kind.index("null")
            kind = kind[1 - null_branch]
        if kind not in SPARK_TYPES:
            raise ValueError(f"{declared['name']}: unsupported Avro type {kind}")
        fields.append(
            avro_batch.Field(
                declared["name"], kind, null_branch, "default" in declared, declared.get("default")
            )
        )
    return fields


def spark_schema(schema: str | dict) -> StructType:
    """The table schema an Avro record decodes to."""
    out = StructType()
    for field in parse_record(schema):
        out = out.add(field.name, SPARK_TYPES[field.kind], True)
    return out


def to_avro(row: Column, schema: str | dict) -> Column:
    """Encode a struct with the schema's field names; NULL in a required field is an error."""
    fields = parse_record(schema)
    if has_spark_avro():
        return spark_avro.to_avro(row, _declaration(schema))

    @F.arrow_udf("binary")
    def encode(rows: pa.Array) -> pa.Array:
        return avro_batch.encode(rows, fields)

    return encode(row)


def from_avro(
    value: Column | str,
    schema: str | dict,
    mode: str = "FAILFAST",
    reader: str | dict | None = None,
) -> Column:
    """Decode payloads written under ``schema`` into a struct of the reader's fields.

    In PERMISSIVE mode a payload that does not decode gives NULL, else it is an error.
    A reader field the writer lacks takes its default.
    """
    written = parse_record(schema)
    wanted = parse_record(reader or schema)
    avro_batch.check_readable(written, wanted)
    strict = _is_strict(mode)
    if has_spark_avro():
        options = {"mode": mode}
        if reader is not None:
            options["avroSchema"] = _declaration(reader)
        return spark_avro.from_avro(value, _declaration(schema), options)

    @F.arrow_udf(spark_schema(reader or schema))
    def decode(values: pa.Array) -> pa.Array:
        return avro_batch.decode(values, written, wanted, strict)

    return decode(value)


def from_framed_avro(
    value: Column | str,
    schemas: dict[int, str | dict],
    reader: str | dict,
    mode: str = "FAILFAST",
) -> Column:
    """Decode framed payloads, each under the schema its header names, into the reader's fields.

    One pass serves all ids: rows of a batch are split by id inside the task.
    """
    written = {schema_id: parse_record(schema) for schema_id, schema in schemas.items()}
    wanted = parse_record(reader)
    for fields in written.values():
        avro_batch.check_readable(fields, wanted)
    strict = _is_strict(mode)

    @F.arrow_udf(spark_schema(reader))
    def decode(values: pa.Array) -> pa.Array:
        return avro_batch.decode_framed(values, written, wanted, strict)

    return decode(value)


def _is_strict(mode: str) -> bool:
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode}")
    return mode == "FAILFAST"
