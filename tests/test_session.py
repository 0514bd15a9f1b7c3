import contextvars
import os
import threading
from types import SimpleNamespace

import pytest

from tablewright import session


def test_scopes_of_two_threads_are_apart(spark):
    """A table written under one thread's scope outlives the release of another's."""
    kept, ready, done = [], threading.Event(), threading.Event()

    def other():
        with session.scratch_scope(spark):
            ready.set()
            done.wait(60)

    thread = threading.Thread(target=lambda: contextvars.Context().run(other))
    thread.start()
    ready.wait(60)
    with session.scratch_scope(spark) as mine:
        kept.append(session.materialise(spark.range(5), "mine"))
        done.set()
        thread.join()
        assert kept[0].count() == 5 and len(mine.paths) == 1
    with pytest.raises(Exception):
        kept[0].count()


def test_jobs_side_by_side_write_into_the_open_scope(spark):
    with session.scratch_scope(spark) as scope:
        session.run_together(spark, lambda: session.materialise(spark.range(3)), lambda: session.materialise(spark.range(4)))
        assert len(scope.paths) == 2


def test_shared_folder_without_scheme_is_resolved_as_spark_does(spark, tmp_path):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = hadoop.get("fs.defaultFS")
    assert session._qualified(spark, f"{tmp_path}/") == f"file:{tmp_path}"
    try:
        # Another default file system: a folder without scheme belongs to it, not to the local disk.
        hadoop.set("fs.defaultFS", "viewfs://shared/")
        hadoop.set("fs.viewfs.mounttable.shared.link./data", f"file://{tmp_path}")
        assert session._qualified(spark, "/data/x") == "viewfs://shared/data/x"
        assert session._qualified(spark, "file:/tmp/x") == "file:/tmp/x"
    finally:
        hadoop.set("fs.defaultFS", before)


def test_local_shared_folder_without_scheme_stays_a_plain_path(spark, tmp_path):
    folder = lambda given: session.scratch_dir(SimpleNamespace(conf={"spark.checkpoint.dir": given}, sparkContext=spark.sparkContext))
    spark.range(3).write.parquet(f"{folder(f'{tmp_path}/')}/t")
    assert "t" in os.listdir(folder(str(tmp_path))) and folder(str(tmp_path)) == str(tmp_path)
    assert folder(f"file://{tmp_path}") == folder(f"file:{tmp_path}") == f"file:{tmp_path}"
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = hadoop.get("fs.defaultFS")
    try:
        hadoop.set("fs.defaultFS", "viewfs://shared/")
        hadoop.set("fs.viewfs.mounttable.shared.link./data", f"file://{tmp_path}")
        assert folder("/data/x") == "viewfs://shared/data/x"
    finally:
        hadoop.set("fs.defaultFS", before)
