"""Rows as dense numeric blocks, scanned many times: what a fit with numpy in the tasks reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks whose sums the driver may add up itself; more are added up in groups first.
DIRECT = 64


def numeric_blocks(data: DataFrame, features_col: str, label_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``x`` (64-bit floats, row by row), ``y`` and a column per name in ``keep``: the rows of each Arrow batch as bytes.

    Kept in memory and on disk; blocks of a lost executor are computed again from the table behind them.
    """
    names = ["y", *keep]
    rows = data.select(vector_to_array(features_col).alias("x"), F.col(label_col).cast("double").alias("y"), *[F.col(c).cast("double") for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = [batch.column("x").flatten(), *(batch.column(c) for c in names)]
                yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy(zero_copy_only=False).astype("<f8").tobytes()]) for c in cells], names=["x", *names])

    return rows.mapInArrow(run, ", ".join(f"{c} binary" for c in ["x", *names])).persist(StorageLevel.MEMORY_AND_DISK)


def unpack(row: dict[str, bytes]) -> dict[str, np.ndarray]:
    """The arrays of one block; ``x`` has a row per row."""
    arrays = {c: np.frombuffer(v, "<f8") for c, v in row.items()}
    arrays["x"] = arrays["x"].reshape(len(arrays["y"]), -1)
    return arrays


def sum_parts(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of the arrays of ``size`` numbers in the binary column ``part``, one row a task.

    Beyond ``DIRECT`` tasks, groups of tasks are added up by other tasks, so that the driver gets about the root of their number.
    """
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in batch.column("part").to_pylist():
                total += np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["part"])

    tasks = parts.rdd.getNumPartitions()
    if tasks > DIRECT:
        parts = parts.repartition(int(tasks ** 0.5) + 1).mapInArrow(merge, "part binary")
    return sum((np.frombuffer(r["part"]) for r in parts.collect()), np.zeros(size))


def block_sums(blocks: DataFrame, size: int, add: Callable[[np.ndarray, dict[str, np.ndarray]], None]) -> np.ndarray:
    """The sum over all tasks of an array of ``size`` numbers, to which ``add`` adds block after block; a task sends one array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for row in batch.to_pylist():
                add(total, unpack(row))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["part"])

    return sum_parts(blocks.mapInArrow(run, "part binary"), size)
