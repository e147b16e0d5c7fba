"""JSON without a declared schema."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.functions.schemaless import (
    json_objects,
    merged_schema,
    not_objects,
    object_columns,
)


def messages(spark, *values):
    return spark.createDataFrame([(v, n) for n, v in enumerate(values)], "value string, n int")


@pytest.mark.parametrize(
    ("values", "schema"),
    [
        (['{"a":1}', '{"b":"x"}'], "struct<a:bigint,b:string>"),
        (['{"a":1}', '{"a":1.5}', '{"a":2e3}'], "struct<a:double>"),
        (['{"a":1}', '{"a":"x"}'], "struct<a:variant>"),
        (['{"a":null}', '{"a":[]}', "{}"], "struct<a:array<string>>"),
        (['{"a":null}'], "struct<a:string>"),
        (['{"a":{}}'], "struct<a:variant>"),
        (['{"a":[{"b":1.5},{"c":null}]}'], "struct<a:array<struct<b:double,c:string>>>"),
        (['{"a":123456789012345678901234567890}'], "struct<a:decimal(30,0)>"),
        (['{"OBJECT":1,"we `ird":{"VOID":null}}'], "struct<OBJECT:bigint,we `ird:struct<VOID:string>>"),
        ([], "struct<>"),
        (["{}"], "struct<>"),
    ],
)
def test_merged_schema(spark, values, schema):
    found = merged_schema(json_objects(messages(spark, *values).repartition(3)))
    assert found.simpleString() == schema


def test_what_is_an_object(spark):
    df = messages(spark, '{"a":1}', "[1]", "7", '"x"', "null", "{bad", "", None, " {} ")
    assert rows(json_objects(df).select("n")) == [(0,), (8,)]
    assert rows(not_objects(df).select("n")) == [(1,), (2,), (3,), (4,), (5,), (6,)]


def test_columns(spark):
    df = messages(
        spark,
        '{"id":1,"Id":"big","name":"é","tags":["x",null]}',
        '{"id":2,"extra":{"k":1.25}}',
        '{"id":null,"extra":{"k":2,"other":true}}',
    )
    found = object_columns(json_objects(df))
    assert found.columns == ["Id", "extra", "id_2", "name", "tags"]
    got = {row["id_2"]: row.asDict(recursive=True) for row in found.collect()}
    assert got[1] == {"Id": "big", "extra": None, "id_2": 1, "name": "é", "tags": ["x", None]}
    assert got[2]["extra"] == {"k": 1.25, "other": None}
    assert got[None]["extra"] == {"k": 2.0, "other": True}


def test_columns_under_a_given_schema(spark):
    objects = json_objects(messages(spark, '{"id":1,"b":2}', "{}"))
    schema = spark.range(0).select("id", F.lit("").alias("c")).schema
    assert rows(object_columns(objects, schema)) == [(1, None), (None, None)]
    assert object_columns(json_objects(messages(spark)), None).columns == []
