"""Session helpers: scratch folder of the cluster and written intermediate tables."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None
# The open scopes of this context: jobs that other threads start side by side do not see them.
_scopes: contextvars.ContextVar[tuple[Scratch, ...]] = contextvars.ContextVar("scopes", default=())


class Scratch:
    """The intermediate tables written since it was opened; ``release`` deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def open(self) -> Scratch:
        _scopes.set((*_scopes.get(), self))
        return self

    def close(self) -> Scratch:
        _scopes.set(tuple(s for s in _scopes.get() if s is not self))
        return self

    def release(self) -> None:
        self.close()
        while self.paths:
            _delete(self.spark, self.paths.pop())


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, at the end, all intermediate tables that operators write inside the block.

    Results that were not collected or written within the block cannot be read after it.
    """
    scope = Scratch(spark).open()
    try:
        yield scope
    finally:
        scope.release()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a ``local[...]`` session may fall back to a temporary folder, since there the driver and the
    tasks share one machine. Elsewhere an unset folder is an error rather than a table that half of
    the executors cannot see.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        found = _qualified(spark, configured)
        # Without a scheme, and local for Spark: it stays a plain path, by which Python finds the same files.
        return found.removeprefix("file:") if not configured.startswith("file:") else found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="tablewright-")
    return _local_scratch


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark resolves it: what opens files without Spark would take one without for a local path."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(conf).makeQualified(folder).toString().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/tablewright/{name}-{uuid.uuid4().hex}"
    for scope in _scopes.get():
        scope.paths.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Used where one plan feeds several jobs. A written table cuts the lineage, survives the loss of
    executors, and, being columnar, lets every later fit read only the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the written tables under the scratch folder that ``df`` reads."""
    spark = df.sparkSession
    root = f"{scratch_dir(spark)}/tablewright/"
    # Files carry a scheme that the configured folder may lack: the folder's own path is what both share.
    inside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"
    tables = {file.split(inside, 1)[1].split("/", 1)[0] for file in df.inputFiles() if inside in file}
    for table in tables:
        _delete(spark, root + table)


def run_together(spark: SparkSession, *jobs: Callable) -> list:
    """Start independent jobs side by side, in the scopes open here, and return their results in order."""
    start = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(contextvars.copy_context().run, start(job)) for job in jobs]
        return [f.result() for f in futures]
