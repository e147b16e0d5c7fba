"""The taxi trip record in its table and message forms."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructType

# Column names and types of the public NYC yellow-taxi trip record.
TAXI_FIELDS = [
    ("VendorID", "long"),
    ("tpep_pickup_datetime", "string"),
    ("tpep_dropoff_datetime", "string"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("RatecodeID", "double"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "long"),
    ("DOLocationID", "long"),
    ("payment_type", "long"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
]

SPARK_TYPES = {"long": LongType(), "double": DoubleType(), "string": StringType()}


def flat_schema(fields: list[tuple[str, str]]) -> StructType:
    """A nullable table schema from (name, long|double|string) pairs."""
    schema = StructType()
    for name, kind in fields:
        schema = schema.add(name, SPARK_TYPES[kind], True)
    return schema


def avro_record(name: str, fields: list[tuple[str, str]], nullable: tuple[str, ...] = ()) -> dict:
    """An Avro record declaration; fields are required unless named in ``nullable``."""
    return {
        "type": "record",
        "name": name,
        "fields": [
            {"name": field, "type": ["null", kind], "default": None}
            if field in nullable
            else {"name": field, "type": kind}
            for field, kind in fields
        ],
    }


TAXI = flat_schema(TAXI_FIELDS)
TAXI_RECORD = avro_record("nyc_taxi_trip", TAXI_FIELDS)
