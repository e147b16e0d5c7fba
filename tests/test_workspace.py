"""Folders of intermediate tables."""

from __future__ import annotations

import threading

import pytest

from millrace.workspace import fresh_dir, path_exists, scratch, staged


def test_scratch_folders_go_at_the_end(spark):
    kept = staged(spark.range(3), "kept")
    with scratch(spark):
        outer = fresh_dir(spark, "outer")
        spark.range(1).write.parquet(outer)
        with scratch(spark):
            inner = fresh_dir(spark, "inner")
            spark.range(1).write.parquet(inner)
            never = fresh_dir(spark, "never-written")
        assert not path_exists(spark, inner)
        assert not path_exists(spark, never)
        assert path_exists(spark, outer)
    assert not path_exists(spark, outer)
    assert kept.count() == 3


def test_scratch_after_a_failure_and_in_other_threads(spark):
    made = []

    def elsewhere():
        made.append(fresh_dir(spark, "elsewhere"))
        spark.range(1).write.parquet(made[-1])

    with pytest.raises(RuntimeError, match="lost"):
        with scratch(spark):
            made.append(fresh_dir(spark, "failed"))
            spark.range(1).write.parquet(made[-1])
            thread = threading.Thread(target=elsewhere)
            thread.start()
            thread.join()
            raise RuntimeError("lost")
    assert [path_exists(spark, path) for path in made] == [False, True]
