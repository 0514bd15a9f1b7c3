"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of the runs of ``[^\\x20\\x09-\\x0D]`` in ``text``; NULL gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def fold_key(id_col: Column) -> Column:
    """crc32 of the id as text; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")))


def sampled(key: Column, most: int, total: int) -> Column:
    """A condition that about ``most`` of ``total`` rows meet, by a 64-bit hash: of any number of rows."""
    return F.xxhash64(key, F.lit("sample")) < F.lit(-(1 << 63) + (most << 64) // total)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def batch_rows(spark: SparkSession, rows: int) -> None:
    """Arrow batches of at most ``rows`` rows in the jobs that follow: few for long texts, many for numbers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows in the jobs run inside the block; the caller's setting afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path within it, for ``file:``, ``hdfs:``, ``s3:`` and other schemes that Arrow opens."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def text_batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Each batch with the UTF-8 bytes of its text column."""
    for batch in batches:
        yield batch, batch.column(column).cast(pa.binary()).to_pylist()
