from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import rows
from millrace.functions.scalar import float_ratio, is_true
from millrace.operators import file_stats, versioned
from millrace.operators.versioned import CommitConflict, VersionedTable


@pytest.fixture
def trips(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 10.0, 2.0), (2, 10.0, 0.0), (3, 9.0, None), (4, None, 3.0), (5, 1.0, 0.5)],
        "id BIGINT, fare_amount DOUBLE, trip_distance DOUBLE",
    )
    return VersionedTable.create(spark, str(tmp_path / "trips"), df.coalesce(1))


def _evolve(table):
    table.rename_column("fare_amount", "fare")
    table.rename_column("trip_distance", "distance")
    table.comment_column("distance", "in miles")
    table.move_column("distance", after="id")
    table.add_column("ratio", "FLOAT", after="distance")


def _by_part(spark, path, parts=4, rows_each=5):
    """A table of one file per part, without partition directories."""
    made = VersionedTable.create(
        spark, str(path), StructType().add("part", "long").add("n", "long")
    )
    for part in range(parts):
        made.append(
            spark.range(0, rows_each, 1, 1).select(F.lit(part).cast("long").alias("part"), F.col("id").alias("n"))
        )
    return made


def test_partitions_in_the_file_list(spark, tmp_path):
    """Values come back as they were, under the column's present name, NULL aside."""
    df = spark.sql("SELECT * FROM VALUES ('a b', 1, 0), ('x/y=+z%', 2, 0), (NULL, 3, 0) v(kind, n, v)")
    table = VersionedTable.create(spark, str(tmp_path / "t"), df, partition_by=["kind"])
    table.rename_column("kind", "sort")
    table.add_partition_field("n")
    table.append(spark.sql("SELECT 'q' AS sort, 7 AS n, 0 AS v"))
    found = [row.partition for row in table.files().collect()]
    key = lambda each: repr(sorted(each.items()))
    wanted = [{"sort": "a b"}, {"sort": "x/y=+z%"}, {"sort": None}, {"sort": "q", "n": "7"}]
    assert sorted(found, key=key) == sorted(wanted, key=key)


def _data_files(table):
    return {row.file_path for row in table.files().select("file_path").collect()}


def test_ratio_of_zero_and_null(spark):
    df = spark.sql("SELECT * FROM VALUES (10D, 0D), (10D, NULL), (NULL, 2D), (9D, 2D) v(a, b)")
    out = df.select(float_ratio("a", "b").alias("r"))
    assert out.dtypes == [("r", "float")]
    assert rows(out) == [(4.5,), (None,), (None,), (None,)]


def test_comparison_after_float_cast(spark):
    df = spark.sql("SELECT CAST(4.00000001D AS FLOAT) AS r, 4.00000001D AS d")
    assert df.select(F.col("r") > 4.0, F.col("d") > 4.0).first() == (False, True)


def test_delete_condition_is_three_valued(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (NULL, 1D), (5D, 1D), (1D, 3D), (1D, 1D) v(ratio, dist)"
    )
    condition = (F.col("ratio") > 4.0) | (F.col("dist") > 2.0)
    assert rows(df.where(~is_true(condition))) == [(1.0, 1.0), (None, 1.0)]


def test_schema_changes_touch_no_file_and_make_no_snapshot(trips):
    before = _data_files(trips)
    _evolve(trips)
    assert trips.schema.names == ["id", "distance", "ratio", "fare"]
    assert trips.schema["distance"].metadata == {"comment": "in miles"}
    assert trips.read().schema["distance"].metadata == {"comment": "in miles"}
    assert _data_files(trips) == before
    assert trips.snapshots().count() == 1
    assert rows(trips.read())[0] == (1, 2.0, None, 10.0)


def test_old_name_used_again_does_not_revive_old_values(trips):
    trips.rename_column("fare_amount", "fare")
    trips.add_column("fare_amount", "DOUBLE")
    assert trips.read().select("id", "fare", "fare_amount").where("id = 1").first() == (1, 10.0, None)
    trips.update({"fare_amount": "id * 2.0D"})
    assert trips.read().select("fare", "fare_amount").where("id = 1").first() == (10.0, 2.0)


def test_refused_schema_changes(trips):
    for change in (
        lambda: trips.rename_column("nope", "x"),
        lambda: trips.rename_column("id", "Fare_Amount"),
        lambda: trips.add_column("ID", "INT"),
        lambda: trips.move_column("id", after="nope"),
        lambda: trips.add_partition_field("fare_amount"),
    ):
        with pytest.raises(ValueError):
            change()
    assert trips.version == 0


def test_move_first(trips):
    trips.move_column("trip_distance", after=None)
    assert trips.read().columns == ["trip_distance", "id", "fare_amount"]


def test_update_delete_snapshots_and_rollback(spark, trips):
    _evolve(trips)
    first = trips.current_snapshot_id
    trips.update({"ratio": float_ratio("fare", "distance")})
    assert trips.snapshots().count() == 2
    assert rows(trips.read().select("id", "ratio")) == [
        (1, 5.0), (2, None), (3, None), (4, None), (5, 2.0)
    ]
    trips.delete((F.col("ratio") > 4.0) | (F.col("distance") > 2.0))
    assert rows(trips.read().select("id")) == [(2,), (3,), (5,)]
    trips.delete(F.col("ratio").isNull())
    assert rows(trips.read().select("id")) == [(5,)]
    assert trips.row_count() == 1
    assert [r.operation for r in trips.snapshots().orderBy("committed_at").collect()] == [
        "append", "overwrite", "overwrite", "overwrite"
    ]
    assert trips.history().orderBy("made_current_at").first().snapshot_id == first
    trips.rollback(first)
    assert trips.snapshots().count() == 4
    assert trips.history().count() == 5
    assert trips.row_count() == 5
    assert trips.schema.names == ["id", "distance", "ratio", "fare"]
    assert rows(trips.read().select("ratio").distinct()) == [(None,)]
    reopened = VersionedTable(spark, trips.root)
    assert rows(reopened.read()) == rows(trips.read())
    ancestors = reopened.history().orderBy("made_current_at").select("is_current_ancestor")
    assert [row[0] for row in ancestors.collect()] == [True, False, False, False, True]
    reopened.update({"ratio": float_ratio("fare", "distance")}, where="distance > 0")
    assert rows(reopened.read().select("id", "ratio"))[0] == (1, 5.0)


def test_rollback_only_to_an_ancestor(trips):
    first = trips.current_snapshot_id
    trips.delete("id = 1")
    second = trips.current_snapshot_id
    trips.rollback(first)
    for wrong in (second, 99):
        with pytest.raises(ValueError, match="not an ancestor"):
            trips.rollback(wrong)


def test_update_where_keeps_false_and_null_rows(trips):
    trips.update({"fare_amount": "0", "trip_distance": "fare_amount"}, where="trip_distance > 1")
    assert rows(trips.read()) == [
        (1, 0.0, 10.0), (2, 10.0, 0.0), (3, 9.0, None), (4, 0.0, None), (5, 1.0, 0.5)
    ]


def test_read_as_of_id_and_time(trips):
    first, names = trips.current_snapshot_id, trips.schema.names
    _evolve(trips)
    trips.delete("id > 2")
    times = {r.snapshot_id: r.committed_at for r in trips.snapshots().collect()}
    assert trips.read(snapshot_id=first).columns == names
    assert trips.read(snapshot_id=first).count() == 5
    assert trips.read(as_of=times[first]).count() == 5
    assert trips.read(as_of=times[trips.current_snapshot_id]).count() == 2
    assert trips.read(as_of=datetime.now() + timedelta(hours=30)).count() == 2
    with pytest.raises(ValueError, match="no snapshot at or before"):
        trips.read(as_of="1999-01-01 00:00:00")
    with pytest.raises(ValueError, match="no snapshot 77"):
        trips.read(snapshot_id=77)


def test_delete_rewrites_only_files_with_such_rows(spark, tmp_path):
    table = _by_part(spark, tmp_path / "t")
    before = _data_files(table)
    table.delete("part = 0 OR part = 1 AND n > 2")
    after = _data_files(table)
    assert len(before & after) == 2 and len(after - before) == 1
    assert table.row_count() == table.read().count() == 13
    summary = table.snapshots().orderBy(F.desc("committed_at")).first().summary
    assert (summary["deleted-data-files"], summary["added-records"]) == ("2", "3")
    table.delete("part = 99")
    assert _data_files(table) == after
    assert table.snapshots().count() == 6
    table.delete("true")
    assert table.snapshots().orderBy(F.desc("committed_at")).first().operation == "delete"
    assert (table.row_count(), table.read().count(), _data_files(table)) == (0, 0, set())
    table.append(spark.sql("SELECT 7L AS part, 7L AS n"))
    assert rows(table.read()) == [(7, 7)]


def test_many_changes_match_the_same_changes_on_a_plain_frame(spark, tmp_path, monkeypatch):
    """Also with the full listing of live files every third commit."""
    monkeypatch.setattr(versioned, "_COMMITS_PER_LISTING", 3)
    table = _by_part(spark, tmp_path / "t", parts=3, rows_each=8)
    expected = {(part, n): n for part in range(3) for n in range(8)}
    table.add_column("v", "BIGINT")
    table.update({"v": "n"})
    seen = []
    for step in range(8):
        part, low = step % 3, step // 2
        if step % 2:
            table.delete(f"part = {part} AND n < {low}")
            expected = {k: v for k, v in expected.items() if not (k[0] == part and k[1] < low)}
        else:
            table.update({"v": "v + 100"}, where=f"part = {part} AND n >= {low}")
            for key in expected:
                if key[0] == part and key[1] >= low:
                    expected[key] += 100
        if step % 3 == 0:
            table.append(spark.sql(f"SELECT {part}L AS part, {50 + step}L AS n, 0L AS v"))
            expected[(part, 50 + step)] = 0
        seen.append((table.current_snapshot_id, dict(expected)))
    for snapshot_id, wanted in seen:
        now = {(r.part, r.n): r.v for r in table.read(snapshot_id=snapshot_id).collect()}
        assert now == wanted
    reopened = VersionedTable(spark, table.root)
    assert reopened.row_count() == reopened.read().count() == len(expected)
    assert any(row.has_carried for row in reopened._log)


def test_partial_files_by_the_shorter_list(spark, tmp_path):
    """Reading what is left of a folder names live files or leaves out removed ones."""
    df = spark.range(0, 60, 1, 6).select("id", (F.col("id") / 10).cast("int").alias("tens"))
    table = VersionedTable.create(spark, str(tmp_path / "t"), df)
    table.delete("tens = 0")
    (files,) = table._file_sets(table.current_snapshot_id)
    assert (len(files.paths), len(files.left_out)) == (1, 1)
    table.delete("tens in (1, 2, 3)")
    (files,) = table._file_sets(table.current_snapshot_id)
    assert (len(files.paths), len(files.left_out)) == (2, 0)
    assert rows(table.read().select("id")) == [(n,) for n in range(40, 60)]


def test_partition_field_applies_to_later_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n BIGINT, flag STRING")
    table = VersionedTable.create(spark, str(tmp_path / "t"), df)
    before = _data_files(table)
    table.rename_column("flag", "label")
    table.add_partition_field("label")
    assert (table.partition_fields, table.snapshots().count()) == (["label"], 1)
    table.append(spark.createDataFrame([(3, "01"), (4, None), (5, "x/y z")], "n BIGINT, label STRING"))
    assert rows(table.read()) == [(1, "a"), (2, None), (3, "01"), (4, None), (5, "x/y z")]
    assert before < _data_files(table)
    plan = table.read().where("label = '01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(flag" in plan
    table.update({"n": "n + 10"}, where="label = 'x/y z'")
    table.delete("label = '01'")
    assert rows(table.read()) == [(1, "a"), (15, "x/y z"), (2, None), (4, None)]
    with pytest.raises(Exception, match="empty string in partition column"):
        table.append(spark.createDataFrame([(6, "")], "n BIGINT, label STRING"))
    assert table.row_count() == 4


def test_create_with_partition_spec(spark, tmp_path):
    schema = StructType().add("n", "long").add("vendor", "long")
    table = VersionedTable.create(spark, str(tmp_path / "t"), schema, partition_by=["vendor"])
    assert (table.row_count(), table.read().count(), table.snapshots().count()) == (0, 0, 0)
    table.append(spark.createDataFrame([(1, 1), (2, 2)], schema))
    assert sorted(p.name for p in tmp_path.glob("t/data/*/vendor=*")) == ["vendor=1", "vendor=2"]
    assert rows(table.read()) == [(1, 1), (2, 2)]


def test_create_modes(spark, tmp_path):
    root = str(tmp_path / "t")
    table = VersionedTable.create(spark, root, spark.range(3))
    with pytest.raises(ValueError, match="table exists"):
        VersionedTable.create(spark, root, spark.range(3))
    assert VersionedTable.create(spark, root, spark.range(9), mode="ignore").row_count() == 3
    first = table.current_snapshot_id
    newer = spark.range(2).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("x"))
    table = VersionedTable.create(spark, root, newer, mode="overwrite")
    assert rows(table.read()) == [("0", 1), ("1", 1)]
    assert rows(table.read(snapshot_id=first)) == [(0,), (1,), (2,)]
    assert table.snapshots().count() == 2


def test_filter_reaches_files_through_a_rename(trips):
    _evolve(trips)
    plan = trips.read().where("fare > 5").select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(fare_amount,5.0)" in text
    assert "ReadSchema: struct<id:bigint,fare_amount:double>" in text


def test_append_needs_the_table_columns(spark, trips):
    with pytest.raises(ValueError, match="do not match"):
        trips.append(spark.range(1))


def test_files_table(spark, trips):
    _evolve(trips)
    (file,) = trips.files().collect()
    assert (file.file_format, file.record_count) == ("PARQUET", 5)
    assert file.null_value_counts == {"id": 0, "fare": 1, "distance": 1}
    assert file.lower_bounds == {"id": "1", "fare": "1.0", "distance": "0.0"} or (
        file.lower_bounds == {"id": "1", "fare": "1.0", "distance": "-0.0"}
    )
    assert file.upper_bounds == {"id": "5", "fare": "10.0", "distance": "3.0"}
    assert trips.files().agg(F.count("*").alias("cnt")).first().cnt == 1


def test_footer_and_scan_statistics_agree(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql(
        "SELECT id, id * 1.5D AS d, CAST(id AS STRING) AS s, id % 2 = 0 AS b, "
        "CASE WHEN id > 3 THEN DATE'2024-01-01' + CAST(id AS INT) END AS day, "
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(id) AS t, "
        "CAST(NULL AS INT) AS e, array(id) AS a, CAST(id AS DECIMAL(9, 2)) AS dec FROM range(1, 40, 1, 3)"
    )
    df.write.parquet(path)
    types = dict(df.dtypes)
    footers = file_stats.stats_from_footers(file_stats.list_parquet(spark, path)).collect()
    scanned = {r.uri: r for r in file_stats.stats_by_scan(spark.read.parquet(path)).collect()}
    assert len(footers) == len(scanned) == 3
    for footer in footers:
        scan = scanned[footer.uri]
        assert footer.record_count == scan.record_count
        flat = {k: v for k, v in scan.null_value_counts.items() if k != "a"}
        assert footer.null_value_counts == flat
        for side in ("lower_bounds", "upper_bounds"):
            one, two = footer[side], scan[side]
            assert one.keys() == two.keys()
            for name in one:
                pair = spark.range(1).select(
                    F.lit(one[name]).cast(types[name]) == F.lit(two[name]).cast(types[name])
                )
                assert pair.first()[0], (side, name)


def test_versions_beyond_the_last_ten_expire(trips):
    for n in range(12):
        trips.comment_column("id", f"note {n}")
    flags = {row.version: row.expired for row in trips.versions(keep=10).collect()}
    assert [version for version, expired in flags.items() if expired] == [0, 1] or sorted(
        version for version, expired in flags.items() if expired
    ) == [0, 1]


def test_two_writers_collide(spark, trips):
    other = VersionedTable(spark, trips.root)
    trips.delete("id = 1")
    with pytest.raises(CommitConflict):
        other.delete("id = 2")
    assert VersionedTable(spark, trips.root).row_count() == 4


def test_log_in_parts(spark, trips, monkeypatch):
    """A long log is read as one list and the rows after it."""
    monkeypatch.setattr(versioned, "_COMMITS_PER_LISTING", 4)
    notes = []
    for n in range(11):
        trips.comment_column("id", f"note {n}")
        notes.append(VersionedTable(spark, trips.root).schema["id"].metadata["comment"])
    assert notes == [f"note {n}" for n in range(11)]
    paths = VersionedTable(spark, trips.root)._log_paths(11)
    assert [path.split("/")[-2:] for path in paths] == [
        ["log_upto", "version=8"], ["log", "version=9"], ["log", "version=10"], ["log", "version=11"]
    ]
    assert trips.versions().count() == 12
    Path(f"{trips.root}/log_upto/version=8/_SUCCESS").unlink()  # as if its writer had failed
    assert len(trips._log_paths(11)) == 8
    assert VersionedTable(spark, trips.root).version == 11
    with pytest.raises(ValueError, match="no table"):
        VersionedTable(spark, trips.root + "-none")


def test_a_log_row_left_half_written_does_not_count(spark, trips):
    Path(f"{trips.root}/log/version=1/_temporary").mkdir(parents=True)
    assert VersionedTable(spark, trips.root).version == 0
    trips.delete("id = 1")
    assert VersionedTable(spark, trips.root).row_count() == 4


def test_files_of_a_failed_commit_are_not_read(spark, trips):
    bad = trips.read().withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        trips.append(bad)
    spark.range(1).write.parquet(f"{trips.root}/data/mr_commit=stray")
    assert trips.read().count() == 5
    trips.append(trips.read())
    assert trips.read().count() == trips.row_count() == 10


def test_changes_to_an_empty_table(spark, tmp_path):
    table = VersionedTable.create(spark, str(tmp_path / "t"), spark.range(1).schema)
    table.delete("id > 1")
    table.update({"id": "id + 1"})
    table.update({"id": "id + 1"}, where="id > 0")
    assert (table.row_count(), table.read().count(), table.snapshots().count()) == (0, 0, 3)
    assert table.files().count() == 0


def test_append_of_no_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n BIGINT, flag STRING")
    for name, by in (("flat", ()), ("parts", ("flag",))):
        table = VersionedTable.create(spark, str(tmp_path / name), df, partition_by=by)
        table.append(df.where("n > 5"))
        assert (table.row_count(), table.snapshots().count()) == (1, 2)
        assert rows(table.read()) == [(1, "a")]


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_root_with_unusual_characters(spark, tmp_path, scheme):
    root = f"{scheme}{tmp_path}/a b%20+c=d"
    df = spark.range(0, 40, 1, 4).select("id", F.concat(F.lit("é %+{"), F.col("id") % 2).alias("p"))
    table = VersionedTable.create(spark, root, df, partition_by=["p"])
    flat = VersionedTable.create(spark, f"{root}-flat", df)
    for made in (table, flat):
        made.delete("id < 10")
        made.update({"id": "-id"}, where="id = 11")
        made.delete("id BETWEEN 20 AND 38")
        assert rows(VersionedTable(spark, made.root).read().select("id")) == rows(
            spark.sql("SELECT -11L UNION ALL SELECT id FROM range(10, 20) WHERE id <> 11 UNION ALL SELECT 39L")
        )


def test_nested_columns(spark, tmp_path):
    df = spark.sql("SELECT id, array(id, 2L) AS list, struct(id AS a, 'x' AS b) AS s FROM range(4)")
    table = VersionedTable.create(spark, str(tmp_path / "t"), df)
    table.rename_column("s", "pair")
    table.delete("pair.a = 1")
    assert rows(table.read()) == rows(df.where("id <> 1"))
    assert all("s" not in file.lower_bounds for file in table.files().collect())


def test_condition_must_be_deterministic(trips):
    for change in (
        lambda: trips.delete("rand() > 0.5"),
        lambda: trips.update({"id": "0"}, where=F.rand() > 0.5),
    ):
        with pytest.raises(ValueError, match="deterministic"):
            change()
    assert trips.version == 0


def test_reserved_column_names(spark, tmp_path, trips):
    with pytest.raises(ValueError, match="reserved"):
        VersionedTable.create(spark, str(tmp_path / "r"), spark.range(1).toDF("mr_file"))
    with pytest.raises(ValueError, match="reserved"):
        trips.add_column("mr_commit", "INT")


def test_range_read_lists_only_files_that_may_match(spark, tmp_path):
    df = spark.range(0, 80, 1, 8).select(
        "id",
        F.when(F.col("id") % 9 != 0, F.col("id") * 1.5).alias("x"),
        F.concat(F.lit("é"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("s"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id"))).alias("t"),
        F.timestamp_seconds(F.col("id") * 86400).alias("z"),
    )
    table = VersionedTable.create(spark, str(tmp_path / "t"), df)
    table.rename_column("x", "y")
    table.add_column("later", "INT")
    for column, low, high in (
        ("id", 15, 31),
        ("y", 22.5, 22.5),
        ("y", None, -1.0),
        ("s", "é07", None),
        ("t", "2024-02-01", datetime(2024, 2, 20, 12)),
        ("z", datetime(1970, 1, 20), datetime(1970, 2, 3)),
        ("later", 0, None),
    ):
        expected = table.read()
        for limit, op in ((low, ">="), (high, "<=")):
            if limit is not None:
                kind = dict(expected.dtypes)[column]
                value = F.lit(limit).cast(kind)
                expected = expected.where(F.col(column) >= value if op == ">=" else F.col(column) <= value)
        assert rows(table.read_range(column, low, high)) == rows(expected), column
    assert len(table.read_range("id", 15, 31).inputFiles()) == 3
    assert len(table.read_range("s", "é07", None).inputFiles()) == 1
    table.delete("id = 16")
    assert rows(table.read_range("id", 15, 18).select("id")) == [(15,), (17,), (18,)]


def test_statistics_by_scan_serve_tables_out_of_reach(spark, tmp_path, monkeypatch):
    """As on a store whose files executors cannot open as plain files."""
    monkeypatch.setattr(file_stats, "is_plain_file_path", lambda *_: False)
    df = spark.range(0, 40, 1, 4).select(
        "id", F.timestamp_seconds(F.col("id") * 86400).alias("z"), (F.col("id") % 2).alias("p")
    )
    table = VersionedTable.create(spark, str(tmp_path / "t"), df, partition_by=["p"])
    table.delete("id < 7")
    assert table.row_count() == table.read().count() == 33
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        found = table.read_range("z", "1970-01-10T00:00:00Z", "1970-01-12T00:00:00Z")
        assert sorted(row.id for row in found.collect()) == [9, 10, 11]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    files = table.files().collect()
    assert sum(file.record_count for file in files) == 33
    assert all(file.null_value_counts == {"id": 0, "z": 0} for file in files)
