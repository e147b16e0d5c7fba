"""Partitioned Parquet tables and SQL tables over them."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalar import is_true
from millrace.operators.partitions import (
    append_new_partitions,
    conflicting_partitions,
    read_partitioned,
    write_partitioned,
)
from millrace.plans.jobs import rewrite_partitions
from millrace.plans.registry import query, table
from millrace.workspace import fresh_dir, path_from_env


def _flags(spark: SparkSession, sf_dir: str, *flags: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin(*flags))


@query("SELECT * FROM lineitem")
def partition_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "by-supplier")
    write_partitioned(table(spark, sf_dir, "lineitem"), path, ["l_suppkey"])
    # partition values come back from directory names as int
    return read_partitioned(spark, path).withColumn("l_suppkey", F.col("l_suppkey").cast("long"))


@query("SELECT * FROM lineitem WHERE l_linenumber = 7")
def partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "by-line")
    write_partitioned(table(spark, sf_dir, "lineitem"), path, ["l_linenumber"])
    return read_partitioned(spark, path).where(F.col("l_linenumber") == 7)


@query("SELECT * FROM lineitem")
def partition_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "rewritten")
    rewrite_partitions(table(spark, sf_dir, "lineitem"), path, "l_returnflag")
    return read_partitioned(spark, path)


@query("SELECT * FROM lineitem WHERE l_returnflag = 'R'")
def partition_overwrite_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "overwritten")
    write_partitioned(_flags(spark, sf_dir, "A", "N"), path, ["l_returnflag"])
    write_partitioned(_flags(spark, sf_dir, "R"), path, ["l_returnflag"], mode="overwrite")
    return read_partitioned(spark, path)


@query(
    "SELECT * FROM lineitem WHERE l_returnflag = 'A' UNION ALL "
    "SELECT * FROM lineitem WHERE l_returnflag = 'N' AND l_quantity > 25"
)
def partition_overwrite_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "overwritten")
    write_partitioned(_flags(spark, sf_dir, "A", "N"), path, ["l_returnflag"])
    newer = _flags(spark, sf_dir, "N").where(F.col("l_quantity") > 25)
    write_partitioned(newer, path, ["l_returnflag"], mode="overwrite", replace="present")
    return read_partitioned(spark, path)


@query("SELECT * FROM lineitem")
def partition_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "appended")
    rows = table(spark, sf_dir, "lineitem")
    first = is_true(F.col("l_returnflag").isin("A", "N"))
    append_new_partitions(rows.where(first), path, ["l_returnflag"])
    append_new_partitions(rows.where(~first), path, ["l_returnflag"])
    return read_partitioned(spark, path)


@query("SELECT DISTINCT l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'N')")
def partition_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "conflicts")
    write_partitioned(_flags(spark, sf_dir, "A", "N"), path, ["l_returnflag"])
    return conflicting_partitions(table(spark, sf_dir, "lineitem"), path, ["l_returnflag"])


@query("SELECT * FROM lineitem")
def save_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"lineitem_{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "lineitem")
    for _ in range(2):  # create, then replace
        writer = rows.write.mode("overwrite").option("path", fresh_dir(spark, "saved"))
        writer.saveAsTable(name)
    return spark.table(name)


def _create_by_flag(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (orderkey BIGINT, price DOUBLE, flag STRING) "
        f"USING parquet PARTITIONED BY (flag) LOCATION '{location}'"
    )


def _insert_flag(spark: SparkSession, name: str, sf_dir: str, flag: str) -> None:
    spark.sql(
        f"INSERT INTO {name} PARTITION (flag = '{flag}') (orderkey, price) "
        "SELECT l_orderkey, l_extendedprice "
        f"FROM parquet.`{sf_dir}/lineitem.parquet` WHERE l_returnflag = '{flag}'"
    )


@query(
    "SELECT l_orderkey AS orderkey, l_extendedprice AS price, l_returnflag AS flag "
    "FROM lineitem WHERE l_returnflag IN ('R', 'A')"
)
def partition_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = f"by_flag_{uuid.uuid4().hex}", fresh_dir(spark, "by-flag")
    _create_by_flag(spark, name, location)
    _insert_flag(spark, name, sf_dir, "R")
    _insert_flag(spark, name, sf_dir, "A")
    return spark.table(name)


@query(
    "SELECT l_orderkey AS orderkey, l_extendedprice AS price, l_returnflag AS flag "
    "FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT -1, 0.5, 'none'"
)
def partition_insert_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row given as values goes to a partition of its own."""
    name, location = f"by_flag_{uuid.uuid4().hex}", fresh_dir(spark, "by-flag")
    _create_by_flag(spark, name, location)
    _insert_flag(spark, name, sf_dir, "R")
    spark.sql(f"INSERT INTO {name} PARTITION (flag = 'none') (orderkey, price) VALUES (-1, 0.5D)")
    return spark.table(name)


@query("SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price FROM orders")
def create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the session's default provider; creating it again changes nothing."""
    name = f"orders_{uuid.uuid4().hex}"
    for _ in range(2):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (id BIGINT, status STRING, price DOUBLE)")
    spark.sql(
        f"INSERT INTO {name} SELECT o_orderkey, o_orderstatus, o_totalprice "
        f"FROM parquet.`{sf_dir}/orders.parquet`"
    )
    return spark.table(name)


@query(
    "SELECT 1 AS databases, o_orderstatus AS status, COUNT(*) AS orders FROM orders GROUP BY ALL"
)
def show_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new database is listed, and a table in it is found by its full name."""
    name, place = f"shop_{uuid.uuid4().hex}", fresh_dir(spark, "database")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{place}'")
    table(spark, sf_dir, "orders").write.saveAsTable(f"{name}.orders")
    listed = spark.sql("SHOW DATABASES").where(F.col("namespace") == name)
    databases = listed.agg(F.count("*").cast("int").alias("databases"))
    orders = spark.table(f"{name}.orders").groupBy(F.col("o_orderstatus").alias("status"))
    # one row on the left
    return orders.agg(F.count("*").alias("orders")).join(F.broadcast(databases), F.lit(True))


@query("SELECT * FROM supplier")
def path_from_environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder to read is named by an environment variable."""
    variable = f"MILLRACE_INPUT_{uuid.uuid4().hex}"
    os.environ[variable] = f"{sf_dir}/supplier.parquet"
    try:
        return spark.read.parquet(path_from_env(variable, ""))
    finally:
        del os.environ[variable]


@query(
    "SELECT l_orderkey AS orderkey, l_extendedprice AS price, l_returnflag AS flag "
    "FROM lineitem WHERE l_returnflag = 'R' UNION ALL "
    "SELECT l_orderkey, l_extendedprice, l_returnflag FROM lineitem WHERE l_returnflag = 'R'"
)
def partition_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropping a table leaves its files; after the next insert into the partition both show."""
    name, location = f"by_flag_{uuid.uuid4().hex}", fresh_dir(spark, "by-flag")
    _create_by_flag(spark, name, location)
    _insert_flag(spark, name, sf_dir, "R")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _create_by_flag(spark, name, location)
    _insert_flag(spark, name, sf_dir, "R")
    return spark.table(name)
