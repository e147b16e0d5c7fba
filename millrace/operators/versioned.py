"""Parquet tables with snapshots, schema evolution, row-level changes and rollback.

For sessions without a table-format catalog; with one, the same statements are plain
Spark SQL. A table is a folder of three parts, each written with ``df.write``:

``data/mr_commit=<id>/``   immutable Parquet files of one commit
``files/mr_commit=<id>/``  which files that commit added or removed, with statistics
``log/version=<n>/``       one row per commit, DDL statement or rollback
``log_upto/version=<n>/``  all log rows so far, every fiftieth version

Commits made together (``append_parts``) have data folders ``<id>-<part>`` of their own, but share
one list of files and one log folder, so log folders are counted apart from versions.

A commit takes effect when its log row is there, marked as complete; whatever a
failed job left behind is never read. Log rows and file lists describe files, not data,
and are the only thing the driver sees. One writer at a time: a writer that finds its
version taken fails, but two at the same moment are not told apart.

Columns keep one physical name in all files, whatever they are called now. So one scan
serves files from before and after a rename, move or added column, filters reach the
files through the renames, and a column added later reads as NULL in older files.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    IntegralType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from millrace.functions.scalar import is_true
from millrace.operators.file_stats import STATS, describe_files
from millrace.workspace import path_exists, path_matches, scratch, staged

_DONE = "_SUCCESS"  # what a finished Spark write leaves in its folder
_COMMIT = "mr_commit"
_URI = "mr_file"
_LOG = (
    StructType()
    .add("event", "string")
    .add("committed_at_us", "long")
    .add("snapshot_id", "long")
    .add("parent_id", "long")
    .add("operation", "string")
    .add("commit_dir", "string")
    .add("extends_parent", "boolean")
    .add("has_carried", "boolean")
    .add("summary", MapType(StringType(), StringType()))
    .add("schema", "string")
    .add("partition_by", ArrayType(StringType()))
    .add("version", "integer")
)
_FILES = (
    StructType(list(STATS.fields))
    .add("status", "string")
    .add("data_commit", "string")
    .add("hits", "long")
    .add(_COMMIT, "string")
)
_ENTRY = [name for name in _FILES.names if name != _COMMIT]
# After so many commits in a row the next one lists all live files, and so often the
# whole log is written again as one. This bounds what a reader has to put together.
_COMMITS_PER_LISTING = 50
# Files to leave out of a folder go into the query plan as literals, so only a few may.
_MAX_LEFT_OUT = 1000


class CommitConflict(Exception):
    """Another writer took the version this one was about to write."""


class VersionedTable:
    """A table under ``root``, as of the version that was current when it was opened."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        last = self._last_logged()
        if last < 0:
            raise ValueError(f"no table: {root}")
        self._logged = last
        rows = spark.read.schema(_LOG).parquet(*self._log_paths(last)).collect()
        self._log: list[Row] = sorted(rows, key=lambda row: row.version)

    # ------------------------------------------------------------ create

    @classmethod
    def exists(cls, spark: SparkSession, root: str) -> bool:
        return path_exists(spark, f"{root.rstrip('/')}/log/version=0/{_DONE}")

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        root: str,
        source: DataFrame | StructType,
        partition_by: tuple[str, ...] | list[str] = (),
        mode: str = "errorifexists",
    ) -> VersionedTable:
        """Create a table from rows (its first snapshot) or from a schema (none yet).

        ``mode`` for a table that is there already: ``errorifexists``, ``ignore``
        (leave it as it is) or ``overwrite`` (a new snapshot with the new schema and
        rows; older snapshots stay readable).
        """
        if mode not in ("errorifexists", "ignore", "overwrite"):
            raise ValueError(f"unknown mode {mode}")
        previous = None
        if cls.exists(spark, root):
            if mode == "errorifexists":
                raise ValueError(f"table exists: {root}")
            previous = cls(spark, root)
            if mode == "ignore":
                return previous
        table = previous or object.__new__(cls)
        if previous is None:
            table.spark, table.root, table._log = spark, root.rstrip("/"), []
            table._logged = -1
        wanted = source if isinstance(source, StructType) else source.schema
        schema = _with_physical_names(wanted, table._all_fields())
        spec = [_field(schema, name).metadata["physical"] for name in partition_by]
        for name in partition_by:
            _check_partition_type(_field(schema, name))
        if isinstance(source, StructType):
            if previous is not None:
                raise ValueError("overwrite needs rows, not a schema")
            table._append_log("create", schema=schema, spec=spec)
        else:
            table._write_snapshot(
                "create" if previous is None else "overwrite",
                source,
                schema=schema,
                spec=spec,
                keep_parent=False,
            )
        return table

    # ------------------------------------------------------------ state

    @property
    def version(self) -> int:
        return self._log[-1].version if self._log else -1

    @property
    def schema(self) -> StructType:
        """Current columns; comments are in the field metadata."""
        return _public(self._schema())

    @property
    def partition_fields(self) -> list[str]:
        """Names of the columns that new files are partitioned by."""
        names = {f.metadata["physical"]: f.name for f in self._schema().fields}
        return [names[physical] for physical in self._log[-1].partition_by]

    @property
    def current_snapshot_id(self) -> int | None:
        return self._log[-1].snapshot_id if self._log else None

    def row_count(self) -> int:
        """Rows of the current snapshot, from its summary: no file is opened."""
        snapshot = self._snapshot(self.current_snapshot_id)
        return 0 if snapshot is None else int(snapshot.summary["total-records"])

    def streams(self) -> set[str]:
        """Names of the streams that added batches."""
        summaries = (row.summary or {} for row in self._log)
        return {summary["stream"] for summary in summaries if "stream" in summary}

    def _is_logged(self, number: int) -> bool:
        return path_exists(self.spark, f"{self.root}/log/version={number}/{_DONE}")

    def _last_logged(self) -> int:
        """The newest log folder, found in few looks whatever their number: there are no gaps."""
        if not self._is_logged(0):
            return -1
        known, missing = 0, 1
        while self._is_logged(missing):
            known, missing = missing, missing * 2
        while missing - known > 1:
            middle = (known + missing) // 2
            if self._is_logged(middle):
                known = middle
            else:
                missing = middle
        return known

    def _log_paths(self, last: int) -> list[str]:
        """The newest list of all log rows, and the single rows after it."""
        start = last - last % _COMMITS_PER_LISTING
        lists = f"{self.root}/log_upto/version="
        while start > 0 and not path_exists(self.spark, f"{lists}{start}/{_DONE}"):
            start -= _COMMITS_PER_LISTING
        single = range(start + 1 if start > 0 else 0, last + 1)
        paths = [f"{self.root}/log/version={version}" for version in single]
        return [f"{lists}{start}", *paths] if start > 0 else paths

    def _schema(self, row: Row | None = None) -> StructType:
        return StructType.fromJson(json.loads((row or self._log[-1]).schema))

    def _all_fields(self) -> list[StructField]:
        seen = {}
        for text in {row.schema: None for row in self._log}:  # few distinct schemas
            for field in StructType.fromJson(json.loads(text)).fields:
                seen[field.metadata["physical"]] = field
        current = self._schema().fields if self._log else []
        seen.update({field.metadata["physical"]: field for field in current})
        return list(seen.values())

    def _snapshot(self, snapshot_id: int | None) -> Row | None:
        """The log row that made a snapshot."""
        if snapshot_id is None:
            return None
        for row in self._log:
            if row.operation is not None and row.snapshot_id == snapshot_id:
                return row
        raise ValueError(f"no snapshot {snapshot_id}")

    def _ancestors(self, snapshot_id: int | None) -> list[Row]:
        """A snapshot and those it came from, newest first."""
        made = {row.snapshot_id: row for row in self._log if row.operation is not None}
        chain = []
        while snapshot_id is not None:
            chain.append(made[snapshot_id])
            snapshot_id = made[snapshot_id].parent_id
        return chain

    def _lineage(self, snapshot_id: int | None) -> list[Row]:
        """The ancestors whose file lists together give a snapshot's live files."""
        lineage = []
        for row in self._ancestors(snapshot_id):
            lineage.append(row)
            if not row.extends_parent:
                break
        return lineage

    # ------------------------------------------------------------ read

    def read(
        self, snapshot_id: int | None = None, as_of: datetime | str | None = None
    ) -> DataFrame:
        """The current rows, or those of an earlier snapshot or time.

        An earlier version has the columns it was written with; after a rollback the
        current columns stay.
        """
        if snapshot_id is not None and as_of is not None:
            raise ValueError("give a snapshot id or a time, not both")
        if as_of is not None:
            snapshot_id = self._snapshot_at(as_of)
        if snapshot_id is None:
            schema, snapshot_id = self._schema(), self.current_snapshot_id
        else:
            schema = self._schema(self._snapshot(snapshot_id))
        scan = self._scan(self._file_sets(snapshot_id))
        return scan.select(*_to_logical(schema))

    def read_range(self, column: str, low: Any = None, high: Any = None) -> DataFrame:
        """Current rows with ``low <= column <= high``, either side open if None.

        Files whose recorded bounds lie outside are not even listed. ``read`` with the same
        filter skips them too, but opens each one's footer to learn of its bounds.
        """
        schema = self._schema()
        field = _field(schema, column)
        physical = F.lit(field.metadata["physical"])
        within, may_match = _quoted(field.name).isNotNull(), F.lit(True)
        for limit, bounds, holds in (
            (low, "upper_bounds", Column.__ge__),
            (high, "lower_bounds", Column.__le__),
        ):
            if limit is not None:
                value = F.lit(limit).cast(field.dataType)
                bound = F.try_element_at(bounds, physical).cast(field.dataType)
                within &= holds(_quoted(field.name), value)
                may_match &= bound.isNull() | holds(bound, value)
        entries = self._live_entries(self._lineage(self.current_snapshot_id)).where(may_match)
        return self._scan(self._cover(entries)).select(*_to_logical(schema)).where(within)

    def _snapshot_at(self, moment: datetime | str) -> int:
        typed = F.unix_micros(F.lit(moment).cast("timestamp"))
        limit = self.spark.range(1).select(typed.alias("us")).first().us
        before = [r for r in self._pointer_moves() if r.committed_at_us <= limit]
        if not before:
            raise ValueError(f"no snapshot at or before {moment}")
        return before[-1].snapshot_id

    def _pointer_moves(self) -> list[Row]:
        return [row for row in self._log if row.operation is not None or row.event == "rollback"]

    def _entries(self, commits: list[str]) -> DataFrame:
        """What commits did to files. Of a list that several made together, their parts of it."""
        base = f"{self.root}/files"
        parts: dict[str, list[int]] = {}
        for commit in commits:
            made, _, part = commit.partition("-")
            parts.setdefault(made, []).extend([int(part)] if part else [])
        paths = [f"{base}/{_COMMIT}={made}" for made in parts]
        entries = self.spark.read.schema(_FILES).option("basePath", base).parquet(*paths)
        part = F.substring_index("data_commit", "-", -1).cast("long")
        for made, numbers in parts.items():
            if numbers:
                wanted = reduce(Column.__or__, (part.between(*run) for run in _runs(numbers)))
                shared = F.col(_COMMIT) == made
                entries = entries.where(~shared | (F.col("status") == "carried") | wanted)
        return entries

    def _live_entries(self, lineage: list[Row]) -> DataFrame:
        listed = [row for row in lineage if _has_entries(row)]
        if not listed:
            return _no_rows(self.spark, _FILES).select(*_ENTRY)
        entries = self._entries([row.commit_dir for row in listed])
        live = entries.where(F.col("status").isin("added", "carried")).select(*_ENTRY)
        if any(row.extends_parent and _count(row, "deleted-data-files") for row in listed):
            # the last row in a lineage starts from nothing: its removals are history
            removed = entries.where((F.col("status") == "removed")).select("uri")
            live = live.join(removed, "uri", "left_anti")
        return live

    def _file_sets(self, snapshot_id: int | None) -> list[_FileSet]:
        """Where a snapshot's live files are, as few and as short paths as possible.

        A commit's folder is named as a whole while all its files are live. Else a list
        goes along: of a few removed files to leave out, or of the live ones.
        """
        lineage = self._lineage(snapshot_id)
        partial = any(row.extends_parent and _count(row, "deleted-data-files") for row in lineage)
        if not partial and not any(row.has_carried for row in lineage):
            specs = {row.commit_dir: tuple(row.partition_by) for row in lineage}
            whole = [row.commit_dir for row in lineage if _count(row, "added-data-files")]
            return _by_spec(self.root, specs, whole, [], [])
        return self._cover(self._live_entries(lineage))

    def _cover(self, wanted: DataFrame) -> list[_FileSet]:
        """Paths for the files in ``wanted`` (entries), folders as a whole where possible."""
        specs = {row.commit_dir: tuple(row.partition_by) for row in self._log if row.commit_dir}
        commits = [row for row in self._log if row.commit_dir]
        added = {row.commit_dir: _count(row, "added-data-files") for row in commits}
        counts = dict(wanted.groupBy("data_commit").count().collect())
        whole, but_few, some = [], [], []
        for commit, n in counts.items():
            others = added[commit] - n
            if others == 0:
                whole.append(commit)
            elif others < n and others <= _MAX_LEFT_OUT:
                but_few.append(commit)
            else:
                some.append(commit)
        picked, left_out = [], []
        if some:
            rows = wanted.where(F.col("data_commit").isin(some))
            picked = rows.select("data_commit", "path").collect()
        if but_few:
            others = self._entries(but_few).where(F.col("status") == "added")
            others = others.join(wanted.select("uri"), "uri", "left_anti")
            left_out = others.select("data_commit", "uri").collect()
        return _by_spec(self.root, specs, whole + but_few, picked, left_out)

    def _scan(self, file_sets: list[_FileSet], with_file: bool = False) -> DataFrame:
        """All columns ever, under their physical names, and on demand each row's file.

        Row by row the file name costs something, even if it is projected away later.
        """
        fields = [
            StructField(f.metadata["physical"], f.dataType, True) for f in self._all_fields()
        ]
        scans = []
        for files in file_sets:
            reader = self.spark.read.schema(StructType(fields))
            scan = reader.option("basePath", f"{self.root}/data").parquet(*files.paths)
            if files.left_out:  # decided per file when the scan is planned
                scan = scan.where(~F.col("_metadata.file_path").isin(files.left_out))
            columns = [_quoted(f.name) for f in fields]
            if with_file:
                columns.append(F.col("_metadata.file_path").alias(_URI))
            scans.append(scan.select(*columns))
        if not scans:
            empty = [*fields, StructField(_URI, StringType())]
            return _no_rows(self.spark, StructType(empty if with_file else fields))
        out = scans[0]
        for scan in scans[1:]:
            out = out.unionByName(scan)
        return out

    # ------------------------------------------------------------ schema

    def rename_column(self, old: str, new: str) -> None:
        schema = self._schema()
        field = _field(schema, old)
        _check_name(new)
        if new.lower() in {f.name.lower() for f in schema.fields if f is not field}:
            raise ValueError(f"column exists: {new}")
        renamed = StructField(new, field.dataType, True, field.metadata)
        self._alter([renamed if f is field else f for f in schema.fields])

    def comment_column(self, name: str, comment: str) -> None:
        schema = self._schema()
        field = _field(schema, name)
        noted = StructField(
            field.name, field.dataType, True, {**field.metadata, "comment": comment}
        )
        self._alter([noted if f is field else f for f in schema.fields])

    def move_column(self, name: str, after: str | None) -> None:
        """Put a column behind another one, or first with ``after=None``."""
        schema = self._schema()
        field = _field(schema, name)
        self._alter(_insert([f for f in schema.fields if f is not field], field, after))

    def add_column(
        self, name: str, kind: str | DataType, after: str | None = None, comment: str | None = None
    ) -> None:
        """Add a column behind ``after``, or last; existing rows have NULL in it."""
        schema = self._schema()
        _check_name(name)
        if name.lower() in {f.name.lower() for f in schema.fields}:
            raise ValueError(f"column exists: {name}")
        if isinstance(kind, str):
            kind = StructType.fromDDL(f"c {kind}")["c"].dataType
        taken = {f.metadata["physical"].lower() for f in self._all_fields()}
        metadata = {"physical": _free_name(name, taken)}
        if comment is not None:
            metadata["comment"] = comment
        field = StructField(name, kind, True, metadata)
        last = schema.fields[-1].name if schema.fields else None
        self._alter(_insert(schema.fields, field, after or last))

    def add_partition_field(self, name: str) -> None:
        """Partition files written from now on by one more column; older files stay as they are."""
        field = _field(self._schema(), name)
        _check_partition_type(field)
        spec = list(self._log[-1].partition_by)
        if field.metadata["physical"] in spec:
            raise ValueError(f"already partitioned by {name}")
        self._append_log("alter", spec=[*spec, field.metadata["physical"]])

    def _alter(self, fields: list[StructField]) -> None:
        self._append_log("alter", schema=StructType(fields))

    # ------------------------------------------------------------ rows

    def append(
        self,
        rows: DataFrame,
        batch: tuple[str, int] | tuple[str, int, int] | tuple[str, int, str] | None = None,
    ) -> bool:
        """Add rows with the table's columns, as one snapshot.

        ``batch`` names a stream, its micro-batch and, if that comes in several, the part of
        it. One that is in the table already is not added again, and the answer is False.
        For several parts at once it names a further column of ``rows``, which tells each row's
        part: see ``append_parts``.
        """
        summary = {}
        if batch is not None and isinstance(batch[-1], str):
            return self.append_parts(rows, batch[-1], batch[:2])
        if batch is not None:
            stream, *number = batch
            number = (*number, 0)[:2]
            done = self._done_of(stream)
            if done is not None and done >= number:
                return False
            summary = _stream_summary(stream, *number)
        self._write_snapshot("append", rows, summary=summary)
        return True

    def append_parts(self, rows: DataFrame, part: str, batch: tuple[str, int]) -> bool:
        """Add a batch's rows as one snapshot for each value of ``part``, in that order.

        ``part`` numbers the parts from 0; the other columns are the table's. All parts are written
        by one job and take effect at once, so that time goes with the rows, not with the
        number of parts. Parts that are in the table already are not added again, and the
        answer is False if that leaves none.
        """
        stream, number = batch
        done = self._done_of(stream)
        if done is not None and done[0] >= number:
            if done[0] > number:
                return False
            rows = rows.where(F.col(part) > done[1])
        schema, spec = self._schema(), list(self._log[-1].partition_by)
        made = _new_commit()
        self._write_data(rows, schema, spec, made, part)
        stored = StructType([f for f in _physical(schema) if f.name not in spec])
        counts = {}
        root = f"{self.root}/data/{_COMMIT}={made}-*"
        if path_matches(self.spark, root):
            new = self._describe(root, stored, F.regexp_extract("uri", f"/{_COMMIT}=([^/]+)/", 1))
            new.write.parquet(self._entry_dir(made))
            sizes = self._all_entries(made).groupBy("data_commit").agg(
                F.count("*").alias("files"), F.sum("record_count").alias("records")
            )
            counts = {int(row.data_commit.partition("-")[2]): row for row in sizes.collect()}
        if not counts:
            return False
        parent = self._snapshot(self.current_snapshot_id)
        carries = self._should_carry(parent)
        if carries:
            self._carry_live_files(made, parent)
        files, records = _count(parent, "total-data-files"), _count(parent, "total-records")
        extends = files > 0
        entries, parent_id = [], self.current_snapshot_id
        for at, size in sorted(counts.items()):
            files, records = files + size.files, records + size.records
            summary = {
                **_stream_summary(stream, number, at),
                **_totals(size.files, size.records, 0, 0, files, records),
            }
            entries.append(
                self._log_row(
                    "append",
                    after=entries[-1] if entries else None,
                    schema=schema,
                    spec=spec,
                    operation="append",
                    parent_id=parent_id,
                    commit=f"{made}-{at}",
                    extends_parent=extends and not carries,
                    has_carried=carries,
                    summary=summary,
                )
            )
            parent_id, extends, carries = entries[-1]["snapshot_id"], True, False
        self._write_log(entries)
        return True

    def _done_of(self, stream: str) -> tuple[int, int] | None:
        """The last micro-batch of a stream, and part of it, that the table has."""
        done = [
            (int(row.summary["stream-batch"]), int(row.summary.get("stream-part", 0)))
            for row in self._log
            if row.summary and row.summary.get("stream") == stream
        ]
        return max(done, default=None)

    def update(
        self, assignments: dict[str, Column | str], where: Column | str | None = None
    ) -> None:
        """Set columns to expressions over the old row, where the condition is true.

        Only files with such rows are rewritten. The condition is evaluated once to find
        them and once to change them, so it must be deterministic.
        """
        schema = self._schema()
        changed = {}
        for name, value in assignments.items():
            field = _field(schema, name)
            changed[field.name] = _expression(value).cast(field.dataType)
        if where is None:
            rows = self.read().withColumns(changed)
            self._write_snapshot("update", rows, keep_parent=False)
            return
        condition = _expression(where)
        commit = _new_commit()
        touched = self._record_touched(commit, lambda rows: rows.where(condition))
        rows = None
        if touched.files:
            values = {
                name: F.when(condition, value).otherwise(_quoted(name))
                for name, value in changed.items()
            }
            rows = self._read_touched(commit, touched).withColumns(values)
        self._write_snapshot("update", rows, commit=commit, touched=touched)

    def delete(self, where: Column | str) -> None:
        """Delete the rows for which the condition is true; NULL keeps the row.

        Files that lose all their rows are dropped unread, files that lose none stay.
        """
        condition = _expression(where)
        commit = _new_commit()
        touched = self._record_touched(commit, lambda rows: rows.where(condition))
        rows = None
        if touched.hits < touched.records:
            rows = self._read_touched(commit, touched, skip_emptied=True)
            rows = rows.where(~is_true(condition))
            if not self._log[-1].partition_by:
                rows = rows.hint("rebalance")  # merge the small rests
        self._write_snapshot("delete", rows, commit=commit, touched=touched)

    def merge(
        self,
        changes: DataFrame,
        keys: Sequence[str],
        last_by: Column | str | None = None,
        deletes: Column | str | None = None,
    ) -> None:
        """Replace rows by those of ``changes`` with the same keys, and add the others.

        ``changes`` has the table's columns, and others that ``last_by`` and ``deletes`` may use.
        Of several changes of a key the one with the greatest ``last_by`` counts (ties: the
        greatest row, so that they always go the same way); without it they are an
        error. A change for which ``deletes`` is true removes its row. NULL keys are equal.
        Only files with rows to replace or remove are read and rewritten.
        """
        schema = self._schema()
        keys = [_field(schema, key).name for key in keys]
        if not keys:
            raise ValueError("a merge needs keys")
        with scratch(self.spark):
            self._merge(staged(_latest(changes, schema, keys, last_by, deletes), "changes"), keys)

    def _merge(self, latest: DataFrame, keys: Sequence[str]) -> None:
        names = self._schema().names

        def same_keys(row: Callable[[str], Column]) -> Column:
            pairs = [row(key).eqNullSafe(latest["row"].getField(key)) for key in keys]
            return reduce(Column.__and__, pairs)

        commit = _new_commit()
        touched = self._record_touched(
            commit, lambda rows: rows.join(latest, same_keys(lambda k: rows[_tick(k)]), "left_semi")
        )
        old = self._read_touched(commit, touched)
        old = old.select(F.struct(*map(_quoted, names)).alias("old"))
        both = old.join(latest, same_keys(lambda k: old["old"].getField(k)), "full")
        left = both.where(~F.coalesce("gone", F.lit(False)))
        rows = left.select(F.coalesce("row", "old").alias("row")).select("row.*")
        self._write_snapshot("merge", rows, commit=commit, touched=touched)

    def _record_touched(
        self, commit: str, matching_rows: Callable[[DataFrame], DataFrame]
    ) -> _Touched:
        """List the files with rows that ``matching_rows`` keeps as removed by ``commit``."""
        lineage = self._lineage(self.current_snapshot_id)
        scan = self._scan(self._file_sets(self.current_snapshot_id), with_file=True)
        logical = scan.select(*_to_logical(self._schema()), F.col(_URI))
        matching = matching_rows(logical)
        if not matching._jdf.queryExecution().analyzed().deterministic():
            raise ValueError("the condition must be deterministic: it is evaluated twice")
        hits = matching.groupBy(F.col(_URI).alias("uri")).agg(F.count("*").alias("hits"))
        live = self._live_entries(lineage).drop("hits", "status")
        gone = live.join(hits, "uri").withColumn("status", F.lit("removed"))
        found = Observation()
        gone = gone.select(*_ENTRY).observe(
            found,
            F.count("*").alias("files"),
            F.sum("record_count").alias("records"),
            F.sum("hits").alias("hits"),
            F.count_if(F.col("hits") == F.col("record_count")).alias("emptied"),
        )
        gone.write.parquet(self._entry_dir(commit))
        return _Touched(**_observed(found, "files", "records", "hits", "emptied"))

    def _read_touched(
        self, commit: str, touched: _Touched, skip_emptied: bool = False
    ) -> DataFrame:
        total = _count(self._snapshot(self.current_snapshot_id), "total-data-files")
        if touched.files == total and not (skip_emptied and touched.emptied):
            file_sets = self._file_sets(self.current_snapshot_id)
        else:
            entries = self._entries([commit]).where(F.col("status") == "removed")
            if skip_emptied:
                entries = entries.where(F.col("hits") < F.col("record_count"))
            file_sets = self._cover(entries)
        return self._scan(file_sets).select(*_to_logical(self._schema()))

    # ------------------------------------------------------------ commit

    def _write_snapshot(
        self,
        event: str,
        rows: DataFrame | None,
        *,
        schema: StructType | None = None,
        spec: list[str] | None = None,
        commit: str | None = None,
        touched: _Touched | None = None,
        keep_parent: bool = True,
        summary: dict[str, str] | None = None,
    ) -> None:
        commit = commit or _new_commit()
        schema = schema or self._schema()
        spec = list(self._log[-1].partition_by) if spec is None else spec
        parent = self._snapshot(self.current_snapshot_id)
        added_files = added_records = 0
        if rows is not None:
            self._write_data(rows, schema, spec, commit)
            root = f"{self.root}/data/{_COMMIT}={commit}"
            stored = StructType([f for f in _physical(schema) if f.name not in spec])
            counts = Observation()
            new = self._describe(root, stored, F.lit(commit)).observe(
                counts, F.count("*").alias("files"), F.sum("record_count").alias("records")
            )
            new.write.mode("append").parquet(self._entry_dir(commit))
            added_files, added_records = _observed(counts, "files", "records").values()
        old_files = _count(parent, "total-data-files")
        old_records = _count(parent, "total-records")
        if parent is None or not keep_parent:
            removed_files, removed_records = old_files, old_records
        elif touched is not None:
            removed_files, removed_records = touched.files, touched.records
        else:
            removed_files = removed_records = 0
        if event in ("create", "append"):
            operation = "append"
        else:  # named by what it did to files, as table formats do
            operation = "delete" if removed_files and not added_files else "overwrite"
        keeps_files = parent is not None and removed_files < old_files
        carries = keeps_files and self._should_carry(parent)
        if carries:
            self._carry_live_files(commit, parent)
        self._append_log(
            event,
            schema=schema,
            spec=spec,
            operation=operation,
            parent_id=None if parent is None else parent.snapshot_id,
            commit=commit,
            extends_parent=keeps_files and not carries,
            has_carried=carries,
            summary={
                **(summary or {}),
                **_totals(
                    added_files,
                    added_records,
                    removed_files,
                    removed_records,
                    old_files - removed_files + added_files,
                    old_records - removed_records + added_records,
                ),
            },
        )

    def _describe(self, root: str, stored: StructType, commit: Column) -> DataFrame:
        """List entries of the files below a commit's folder, or those of several."""
        new = describe_files(self.spark, root, stored).where("record_count > 0")
        new = new.withColumns(
            {
                "status": F.lit("added"),
                "data_commit": commit,
                "hits": F.lit(None).cast("long"),
            }
        )
        return new.select(*_ENTRY)

    def _all_entries(self, made: str) -> DataFrame:
        return self.spark.read.schema(_FILES).parquet(self._entry_dir(made))

    def _should_carry(self, parent: Row | None) -> bool:
        """Whether a reader of the next snapshot would put together too many lists of files."""
        if parent is None:
            return False
        lists = {row.commit_dir.partition("-")[0] for row in self._lineage(parent.snapshot_id)}
        return len(lists) >= _COMMITS_PER_LISTING

    def _write_data(
        self,
        rows: DataFrame,
        schema: StructType,
        spec: list[str],
        commit: str,
        part: str | None = None,
    ) -> None:
        given = {name.lower(): name for name in rows.columns if name != part}
        names = {f.name.lower() for f in schema.fields}
        if given.keys() != names or len(rows.columns) != len(names) + (part is not None):
            raise ValueError(f"columns {rows.columns} do not match {schema.names}")
        out = []
        for field in schema.fields:
            value = _quoted(given[field.name.lower()]).cast(field.dataType)
            physical = field.metadata["physical"]
            if physical in spec and isinstance(field.dataType, StringType):
                # a partition directory cannot tell an empty string from NULL
                refused = F.raise_error(F.lit(f"empty string in partition column {field.name}"))
                value = F.when(value == "", refused).otherwise(value)
            out.append(value.alias(physical))
        if part is not None:
            folder = F.concat(F.lit(f"{commit}-"), _quoted(part).cast("string")).alias(_COMMIT)
            df = rows.select(*out, folder).hint("rebalance", _COMMIT, *spec)
            df.write.mode("append").partitionBy(_COMMIT, *spec).parquet(f"{self.root}/data")
            return
        df = rows.select(*out)
        target = f"{self.root}/data/{_COMMIT}={commit}"
        if spec:  # few full files per partition, a hot partition still split over tasks
            df.hint("rebalance", *spec).write.partitionBy(*spec).parquet(target)
        else:
            df.write.parquet(target)

    def _carry_live_files(self, commit: str, parent: Row) -> None:
        live = self._live_entries(self._lineage(parent.snapshot_id))
        own = self._entry_dir(commit)
        if path_exists(self.spark, own):
            gone = self._entries([commit]).where(F.col("status") == "removed").select("uri")
            live = live.join(gone, "uri", "left_anti")
        carried = live.withColumns({"status": F.lit("carried"), "hits": F.lit(None).cast("long")})
        carried.select(*_ENTRY).write.mode("append").parquet(own)

    def _entry_dir(self, commit: str) -> str:
        return f"{self.root}/files/{_COMMIT}={commit}"

    def _append_log(
        self,
        event: str,
        *,
        schema: StructType | None = None,
        spec: list[str] | None = None,
        operation: str | None = None,
        parent_id: int | None = None,
        snapshot_id: int | None = None,
        commit: str | None = None,
        extends_parent: bool | None = None,
        has_carried: bool | None = None,
        summary: dict[str, str] | None = None,
    ) -> None:
        self._write_log(
            [
                self._log_row(
                    event,
                    schema=schema,
                    spec=spec,
                    operation=operation,
                    parent_id=parent_id,
                    snapshot_id=snapshot_id,
                    commit=commit,
                    extends_parent=extends_parent,
                    has_carried=has_carried,
                    summary=summary,
                )
            ]
        )

    def _log_row(
        self,
        event: str,
        *,
        after: dict[str, Any] | None = None,
        schema: StructType | None,
        spec: list[str] | None,
        operation: str | None,
        parent_id: int | None,
        snapshot_id: int | None = None,
        commit: str | None,
        extends_parent: bool | None,
        has_carried: bool | None,
        summary: dict[str, str] | None,
    ) -> dict[str, Any]:
        """The log row that follows the last one, or one that is still to be written."""
        last = Row(**after) if after else self._log[-1] if self._log else None
        version = 0 if last is None else last.version + 1
        if operation is not None:
            snapshot_id = version + 1
        elif snapshot_id is None:
            snapshot_id = self.current_snapshot_id
        now = time.time_ns() // 1000
        return {
            "event": event,
            "committed_at_us": now if last is None else max(now, last.committed_at_us + 1),
            "snapshot_id": snapshot_id,
            "parent_id": parent_id,
            "operation": operation,
            "commit_dir": commit,
            "extends_parent": extends_parent,
            "has_carried": has_carried,
            "summary": summary,
            "schema": (schema or self._schema()).json(),
            "partition_by": list(last.partition_by) if spec is None else spec,
            "version": version,
        }

    def _write_log(self, entries: list[dict[str, Any]]) -> None:
        """Write the rows of what is committed at once, as one log folder."""
        number = self._logged + 1
        if self._is_logged(number):
            raise CommitConflict(f"version {number} of {self.root} was written by another writer")
        # one text for all, so that a plan has one literal whatever the number of rows
        entry = F.explode(F.from_json(F.lit(json.dumps(entries)), ArrayType(_LOG)))
        df = self.spark.range(1, numPartitions=1).select(entry.alias("entry")).select("entry.*")
        # overwrites no more than what a writer that failed half way may have left
        df.write.mode("overwrite").parquet(f"{self.root}/log/version={number}")
        self._logged = number
        self._log.extend(Row(**entry) for entry in entries)
        if number and number % _COMMITS_PER_LISTING == 0:
            # readers do without this list if the writer fails here
            self._log_frame().write.mode("overwrite").parquet(
                f"{self.root}/log_upto/version={number}"
            )

    # ------------------------------------------------------------ metadata

    def _log_frame(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(*self._log_paths(self._logged))

    def snapshots(self) -> DataFrame:
        """One row per commit: when, id, parent, operation and summary."""
        return (
            self._log_frame()
            .where(F.col("operation").isNotNull())
            .select(
                F.timestamp_micros("committed_at_us").alias("committed_at"),
                "snapshot_id",
                "parent_id",
                "operation",
                "summary",
            )
        )

    def history(self) -> DataFrame:
        """One row each time a snapshot became current, rollbacks among them."""
        ancestors = [row.snapshot_id for row in self._ancestors(self.current_snapshot_id)]
        return (
            self._log_frame()
            .where(F.col("operation").isNotNull() | (F.col("event") == "rollback"))
            .select(
                F.timestamp_micros("committed_at_us").alias("made_current_at"),
                "snapshot_id",
                "parent_id",
                F.col("snapshot_id").isin(ancestors).alias("is_current_ancestor"),
            )
        )

    def files(self, snapshot_id: int | None = None) -> DataFrame:
        """One row per live data file; map keys are the current column names.

        ``partition`` has the values, as text, of the columns its folder is named by. A
        partition may have any number of files.
        """
        wanted = self.current_snapshot_id if snapshot_id is None else snapshot_id
        if wanted is not None:
            self._snapshot(wanted)
        names = {f.metadata["physical"]: f.name for f in self._all_fields()}
        pairs = [F.lit(text) for pair in names.items() for text in pair]

        def current_name(physical: Column) -> Column:
            return F.create_map(*pairs)[physical]

        def renamed(stats: str) -> Column:
            current = F.create_map(*pairs)
            return F.transform_keys(stats, lambda key, _: current[key]).alias(stats)

        folders = F.regexp_extract("path", f"/{_COMMIT}=[^/]+/(.*?)[^/]*$", 1)
        pairs_of = F.transform(
            F.filter(F.split(folders, "/"), lambda folder: folder != ""),
            lambda folder: F.struct(
                current_name(_unescaped(F.substring_index(folder, "=", 1))).alias("key"),
                F.nullif(
                    _unescaped(F.regexp_replace(folder, "^[^=]*=", "")),
                    F.lit("__HIVE_DEFAULT_PARTITION__"),
                ).alias("value"),
            ),
        )
        return self._live_entries(self._lineage(wanted)).select(
            F.col("path").alias("file_path"),
            F.lit("PARQUET").alias("file_format"),
            F.map_from_entries(pairs_of).alias("partition"),
            "record_count",
            F.col("file_size").alias("file_size_in_bytes"),
            renamed("null_value_counts"),
            renamed("lower_bounds"),
            renamed("upper_bounds"),
        )

    def versions(self, keep: int = 10) -> DataFrame:
        """Every logged version, those before the last one and ``keep`` previous ones expired."""
        return self._log_frame().select(
            "version",
            "event",
            "snapshot_id",
            F.timestamp_micros("committed_at_us").alias("committed_at"),
            (F.col("version") < self.version - keep).alias("expired"),
        )

    def rollback(self, snapshot_id: int) -> None:
        """Make an ancestor of the current snapshot current again; columns stay as they are."""
        known = {row.snapshot_id for row in self._ancestors(self.current_snapshot_id)}
        if snapshot_id not in known:
            raise ValueError(f"snapshot {snapshot_id} is not an ancestor of the current one")
        parent = self._snapshot(snapshot_id).parent_id
        self._append_log("rollback", snapshot_id=snapshot_id, parent_id=parent)


# ---------------------------------------------------------------- helpers


class _FileSet:
    """Paths with one partition layout, and files below them that are not wanted."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.left_out: list[str] = []


class _Touched:
    """Files a change reaches, rows in them, rows it applies to, files it applies to wholly."""

    def __init__(self, files: int, records: int, hits: int, emptied: int) -> None:
        self.files, self.records, self.hits, self.emptied = files, records, hits, emptied


def _by_spec(
    root: str,
    specs: dict[str, tuple[str, ...]],
    folders: list[str],
    picked: list[Row],
    left_out: list[Row],
) -> list[_FileSet]:
    sets: dict[tuple[str, ...], _FileSet] = {}
    for commit in folders:
        files = sets.setdefault(specs[commit], _FileSet())
        files.paths.append(f"{root}/data/{_COMMIT}={commit}")
    for row in picked:
        sets.setdefault(specs[row.data_commit], _FileSet()).paths.append(row.path)
    for row in left_out:
        sets[specs[row.data_commit]].left_out.append(row.uri)
    return list(sets.values())


def _no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(0).select(*nulls)


def _observed(counts: Observation, *names: str) -> dict[str, int]:
    """Totals a write job counted on its way; a job without rows may report none."""
    found = counts.get
    return {name: int(found.get(name) or 0) for name in names}


def _physical(schema: StructType) -> list[StructField]:
    return [StructField(f.metadata["physical"], f.dataType) for f in schema.fields]


def _runs(numbers: list[int]) -> list[tuple[int, int]]:
    """First and last of each stretch of consecutive numbers."""
    runs: list[tuple[int, int]] = []
    for number in sorted(numbers):
        if runs and number == runs[-1][1] + 1:
            runs[-1] = (runs[-1][0], number)
        else:
            runs.append((number, number))
    return runs


def _stream_summary(stream: str, batch: int, part: int) -> dict[str, str]:
    return {"stream": stream, "stream-batch": str(batch), "stream-part": str(part)}


def _totals(
    added_files: int,
    added_records: int,
    deleted_files: int,
    deleted_records: int,
    total_files: int,
    total_records: int,
) -> dict[str, str]:
    return {
        "added-data-files": str(added_files),
        "added-records": str(added_records),
        "deleted-data-files": str(deleted_files),
        "deleted-records": str(deleted_records),
        "total-data-files": str(total_files),
        "total-records": str(total_records),
    }


def _new_commit() -> str:
    return uuid.uuid4().hex


def _count(row: Row | None, key: str) -> int:
    return 0 if row is None else int(row.summary[key])


def _has_entries(row: Row) -> bool:
    carried_or_gone = row.has_carried or (row.extends_parent and _count(row, "deleted-data-files"))
    return bool(_count(row, "added-data-files") or carried_or_gone)


def _quoted(name: str) -> Column:
    return F.col(_tick(name))


def _expression(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _latest(
    changes: DataFrame,
    schema: StructType,
    keys: Sequence[str],
    last_by: Column | str | None,
    deletes: Column | str | None,
) -> DataFrame:
    """One change for each key: ``row`` with all columns of the table, ``gone`` if it removes."""
    cells = [_quoted(field.name).cast(field.dataType).alias(field.name) for field in schema.fields]
    gone = F.lit(False) if deletes is None else is_true(_expression(deletes))
    place = F.lit(None).cast("long") if last_by is None else _expression(last_by)
    change = F.struct(place.alias("place"), gone.alias("gone"), F.struct(*cells).alias("row"))
    each = changes.select(change.alias("change"))
    groups = [F.col("change.row").getField(key).alias(f"key {at}") for at, key in enumerate(keys)]
    if last_by is None:
        repeated = F.raise_error(F.lit("two changes of one key, and nothing tells the last"))
        found = F.when(F.count("*") > 1, repeated).otherwise(F.first("change"))
    else:
        found = F.max("change")
    latest = each.groupBy(*groups).agg(found.alias("change"))
    return latest.select("change.row", "change.gone")


def _unescaped(folder: Column) -> Column:
    """A name or value as it was before it was made part of a folder's name."""
    return F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _check_name(name: str) -> None:
    if name.lower() in (_COMMIT, _URI):
        raise ValueError(f"reserved column name: {name}")


def _field(schema: StructType, name: str) -> StructField:
    for field in schema.fields:
        if field.name.lower() == name.lower():
            return field
    raise ValueError(f"no column {name}")


def _insert(
    fields: list[StructField], field: StructField, after: str | None
) -> list[StructField]:
    at = 0
    if after is not None:
        anchor = _field(StructType(fields), after).name
        at = [f.name for f in fields].index(anchor) + 1
    return [*fields[:at], field, *fields[at:]]


def _free_name(name: str, taken: set[str]) -> str:
    candidate, n = name, 1
    while candidate.lower() in taken:
        n += 1
        candidate = f"{name}_{n}"
    return candidate


def _with_physical_names(wanted: StructType, known: list[StructField]) -> StructType:
    """Give each column its name in files; a known one of equal name and type keeps it."""
    by_name = {(f.name.lower(), f.dataType.json()): f for f in known}
    taken = {f.metadata["physical"].lower() for f in known}
    out = StructType()
    for field in wanted.fields:
        _check_name(field.name)
        same = by_name.get((field.name.lower(), field.dataType.json()))
        physical = same.metadata["physical"] if same else _free_name(field.name, taken)
        taken.add(physical.lower())
        metadata = {"physical": physical}
        if "comment" in field.metadata:
            metadata["comment"] = field.metadata["comment"]
        out = out.add(StructField(field.name, field.dataType, True, metadata))
    return out


def _public(schema: StructType) -> StructType:
    fields = []
    for field in schema.fields:
        shown = {k: v for k, v in field.metadata.items() if k == "comment"}
        fields.append(StructField(field.name, field.dataType, True, shown))
    return StructType(fields)


def _to_logical(schema: StructType) -> list[Column]:
    shown = _public(schema)
    return [
        _quoted(field.metadata["physical"]).alias(public.name, metadata=public.metadata)
        for field, public in zip(schema.fields, shown.fields, strict=True)
    ]


def _check_partition_type(field: StructField) -> None:
    if not isinstance(field.dataType, (StringType, IntegralType, DateType, BooleanType)):
        raise ValueError(f"cannot partition by {field.name}: {field.dataType.simpleString()}")
