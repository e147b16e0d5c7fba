"""Where jobs put tables, topics and stream checkpoints."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Options of a batch writer of very many files. On file: paths, mounted ones too, Spark writes a
#: checksum file beside each file and starts a process for the permissions of either, twice;
#: with these only the file itself, once. Other file systems take no notice.
BARE_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}

_STORE = "spark.sql.streaming.stateStore"
_STORES = "org.apache.spark.sql.execution.streaming.state"

#: Settings of streams whose state grows. Spark's usual store holds the state of two versions in the
#: executors' heap and copies all of it for every batch; RocksDB, a part of Spark, has it on the
#: executors' disks, at most 500 MB an executor (Spark's default) of it in memory, and saves what a batch
#: changed. Rows are not counted, which would look up each one that is written: progress shows
#: no total of them. Checkpoint files on file: paths have Spark's own checksums, not Hadoop's as well.
LARGE_STATE = {
    f"{_STORE}.providerClass": f"{_STORES}.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    "fs.AbstractFileSystem.file.impl": "org.apache.hadoop.fs.local.RawLocalFs",
}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may go without it; there one process does all the
    work, so the machine's temporary folder is as good as shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.gettempdir()
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


_scopes = threading.local()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared root that nothing has written to yet."""
    path = f"{shared_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    for made in getattr(_scopes, "open", ()):
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes all folders that ``fresh_dir`` names inside, of this thread, at the end.

    What is to last must have been written elsewhere, or read, by then. After a failure the
    folders go as well.
    """
    made: list[str] = []
    _scopes.open = [*getattr(_scopes, "open", ()), made]
    try:
        yield
    finally:
        _scopes.open = [other for other in _scopes.open if other is not made]
        for path in made:
            remove_path(spark, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows, written below the shared root and read back: evaluated once, whatever follows."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bare_files(spark: SparkSession) -> Iterator[None]:
    """``BARE_FILES`` for streams into files that start inside.

    Such a sink takes no file system options from its writer, only from the session that
    starts it, as that is then; the session has its own settings back at the end.
    """
    with _settings(spark, BARE_FILES):
        yield


@contextmanager
def large_state(spark: SparkSession) -> Iterator[None]:
    """``LARGE_STATE`` for streams that start inside; a store that the session names itself stays.

    A stream that goes on from a checkpoint keeps the store it began with.
    """
    own = spark.conf.get(f"{_STORE}.providerClass") != f"{_STORES}.HDFSBackedStateStoreProvider"
    with _settings(spark, {} if own else LARGE_STATE):
        yield


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session with these settings, and with its own again at the end."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of the file system Spark would use for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def path_matches(spark: SparkSession, pattern: str) -> bool:
    """Whether there is any path of a pattern."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this session's own making, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def is_plain_file_path(spark: SparkSession, path: str) -> bool:
    """Whether executors reach a path as ordinary files, a shared mount for one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"


def path_from_env(variable: str, default: str) -> str:
    """A location named by an environment variable, or the default."""
    return os.getenv(variable, default)
