"""Exact k nearest neighbours by boxes.

Brute force compares every test row with every training row. Here the training rows fall into the cells of a tree of
median cuts, learnt from a sample, and the distance of a test row to the box around a cell tells whether the cell can
hold a neighbour at all:

1. each test row searches its home cell, which yields an upper bound for the distance of its k-th neighbour;
2. it then visits only the cells whose box is not farther than that.

Cells travel as numpy blocks of at most ``CELL_BYTES``, so a cell that holds a third of the table is many blocks, and a task
holds one of them and a bounded block of its visitors. Inside a task the same is done once more: a tree with small leaves over
the training rows, visitors in batches of neighbours, and leaves by their distance to the box around the batch. A block emits
the k best of each visitor, never the pairs.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.session import materialise, release

DIGITS = 9
#: Two distances that round alike differ by less.
_SLACK = 2 * 10.0 ** -DIGITS
#: Bytes of vectors in a block of training rows, or of test rows.
CELL_BYTES = 24 << 20
#: Training rows of a leaf of the tree within a task, test rows searched side by side, rows in one written piece.
LEAF_ROWS, BATCH_ROWS, PIECE_ROWS = 64, 32, 512
_SLICE_CELLS = {1: 100_000, 2: 400_000}


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Arrow list column to a matrix, one row per list."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _box(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The box around the rows, NaN cells aside; a side without any number is empty."""
    low, high = np.fmin.reduce(x), np.fmax.reduce(x)
    return np.where(np.isnan(low), np.inf, low), np.where(np.isnan(high), -np.inf, high)


def _cut(x: np.ndarray) -> tuple[int, float] | None:
    """Dimension and value: rows up to the value, a median of the widest dimension, go left and the others right. None if no cut parts the rows."""
    low, high = _box(x)
    width = np.where(high > low, high - low, 0.0)
    j = int(width.argmax())
    if not width[j]:
        return None
    column = x[:, j]
    column = column[~np.isnan(column)]
    middle = (len(column) - 1) // 2
    value = np.partition(column, middle)[middle]
    return j, float(value if value < high[j] else column[column < high[j]].max())


def _box_distances(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray, p: int) -> np.ndarray:
    """Least distances between points of a box, or of one box per row of a column of them, and points of each box."""
    gap = np.maximum(np.maximum(lows - high, low - highs), 0.0)
    return gap.sum(axis=-1) if p == 1 else np.sqrt((gap * gap).sum(axis=-1))


def _widened(bound):
    """The bound with a slack that covers rounded distances."""
    return bound * (1 + 1e-9) + 10.0 ** (1 - DIGITS)


def _kth_bound(d: np.ndarray, k: int) -> np.ndarray:
    """An upper bound of the k-th smallest value of each row: the k-th smallest of the minima of groups."""
    groups = min(d.shape[1], max(64, 4 * k))
    width = d.shape[1] // groups
    minima = d[:, :groups * width].reshape(len(d), width, groups).min(axis=1)  # any groups will do
    return np.partition(minima, k - 1, axis=1)[:, k - 1]


def _near(a: np.ndarray, b: np.ndarray, k: int, p: int, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows of a, rows of b, lower bounds of their distances) of the pairs that may be among the k nearest of a row of a, and a new bound ``best`` of its k-th distance.

    Manhattan distances are summed in 32 bits, squares of Euclidean ones come from the inner products. Both err by rounding only: pairs within a margin of the
    bound are kept, and the distances that count are computed from the differences afterwards.
    """
    if p == 1:
        most = float(np.nansum(np.fmax.reduce(np.abs(a)) + np.fmax.reduce(np.abs(b))))
        kind = np.float32 if most < 1e30 else np.float64
        d, gap = np.zeros((len(a), len(b)), kind), np.empty((len(a), len(b)), kind)
        for x, y in zip(a.T.astype(kind), np.ascontiguousarray(b.T, kind)):
            np.subtract(x[:, None], y, out=gap)
            d += np.abs(gap, out=gap)
        error = np.full(len(a), most * float(np.finfo(kind).eps) * (a.shape[1] + 4))
        if len(b) >= k:
            best = np.fmin(best, _kth_bound(d, k) + error)
        limit = np.nextafter((best + _SLACK + error).astype(kind), kind(np.inf))
    else:
        size_a, size_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
        d = a @ b.T
        d *= -2.0
        d += size_b
        d += size_a[:, None]
        error = 1e-12 * (size_a + np.fmax.reduce(size_b))
        if len(b) >= k:
            best = np.fmin(best, np.sqrt(np.maximum(_kth_bound(d, k) + error, 0.0)))
        limit = (best + _SLACK) ** 2 + error
    rows, hits = np.divmod(np.flatnonzero(d <= limit[:, None]), d.shape[1])
    least = d[rows, hits] - error[rows]
    return rows, hits, least if p == 1 else np.sqrt(np.maximum(least, 0.0)), best


def _leaves(a: np.ndarray, b: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of b by leaf of a tree of cuts, and the rows of a in the order of the leaves they lie in. Of equal rows of b the first k are enough."""
    open_, leaves, order = [(np.arange(len(a)), np.arange(len(b)))], [], []
    while open_:
        tests, rows = open_.pop()
        cut = None
        if len(rows) > LEAF_ROWS:
            x = b[rows]
            cut = _cut(x)
            if cut is None and (x == x[0]).all():
                rows = rows[:k]
        if cut is None:
            leaves.append(rows)
            order.append(tests)
        else:
            j, value = cut
            left, left_tests = x[:, j] <= value, a[tests, j] <= value
            open_ += [(tests[~left_tests], rows[~left]), (tests[left_tests], rows[left])]
    return leaves, np.concatenate(order)


def _nearest(a: np.ndarray, b: np.ndarray, k: int, p: int, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance) of the k nearest of each row of a, ties to the lower row of b, by row of a and distance; with ``bound``, of those within it."""
    leaves, order = _leaves(a, b, k)
    boxes = [_box(b[rows]) for rows in leaves]
    lows, highs = (np.stack(side) for side in zip(*boxes))
    sizes = np.array([len(rows) for rows in leaves])
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    rows_of = np.concatenate(leaves)
    b = b[rows_of]
    limit = np.full(len(a), np.inf) if bound is None else _widened(bound)
    found = []
    start, width = 0, BATCH_ROWS
    while start < len(a):
        tests = order[start:start + width]
        x, best = a[tests], limit[tests]
        box = _box(x)
        least = _box_distances(*box, lows, highs, p)
        by_distance = np.argsort(least, kind="stable")
        least, ends = least[by_distance], np.cumsum(sizes[by_distance])
        at, done, take, pairs = 0, 0, max(4 * k, 4 * LEAF_ROWS), []
        most = max(1, _SLICE_CELLS[p] // len(x))
        while at < len(least):
            stop = np.searchsorted(least, _widened(best.max()), side="right")
            if stop <= at:
                break
            upto = min(stop, max(at + 1, int(np.searchsorted(ends, done + min(take, most), side="right"))))
            some = np.sort(by_distance[at:upto])
            rows = np.concatenate([np.arange(firsts[i], firsts[i + 1]) for i in some])
            at, done, take = upto, int(ends[upto - 1]), 4 * take
            y = b[rows]
            if math.isfinite(top := best.max()):
                inside = np.flatnonzero(_box_distances(*box, y, y, p) <= _widened(top))
                if not len(inside):
                    continue
                rows, y = (rows, y) if len(inside) == len(rows) else (rows[inside], y[inside])
            near, hits, d, best = _near(x, y, k, p, best)
            pairs.append((near, rows[hits], d))
        near, hits, d = (np.concatenate(column) for column in zip(*pairs)) if pairs else (np.empty(0, int),) * 3
        inside = d <= best[near] + _SLACK
        near, hits = near[inside], hits[inside]
        gap = x[near] - b[hits]
        d = np.abs(gap).sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1))
        d, hits = np.round(d, DIGITS), rows_of[hits]
        place = np.lexsort((hits, d, near))
        near, hits, d = near[place], hits[place], d[place]
        first = np.arange(len(near)) - np.searchsorted(near, near) < k
        found.append((tests[near[first]], hits[first], d[first]))
        # Where boxes exclude little, wide batches cost less.
        start, width = start + width, min(2 * width, 8 * BATCH_ROWS) if 4 * done > len(b) else BATCH_ROWS
    rows, hits, d = (np.concatenate(column) for column in zip(*found))
    place = np.argsort(rows, kind="stable")
    return rows[place], hits[place], d[place]


class _Cells:
    """A tree of cuts: the number of the cell of each row."""

    def __init__(self, sample: np.ndarray, wanted: int):
        self.nodes: list[tuple] = [(-1, 0.0, 0, 0)]
        largest, self.n = [(-len(sample), 0, sample)], 1
        while largest and self.n < wanted:
            _, node, x = heapq.heappop(largest)
            cut = _cut(x) if len(x) else None
            if cut is None:
                continue
            j, value = cut
            left, cell, at = x[:, j] <= value, self.nodes[node][2], len(self.nodes)
            self.nodes += [(-1, 0.0, cell, 0), (-1, 0.0, self.n, 0)]
            self.nodes[node] = (j, value, at, at + 1)
            self.n += 1
            for number, part in ((at, x[left]), (at + 1, x[~left])):
                heapq.heappush(largest, (-len(part), number, part))

    def of(self, x: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            j, value, left, right = self.nodes[node]
            if j < 0:
                out[rows] = left
            elif len(rows):
                below = x[rows, j] <= value
                open_ += [(left, rows[below]), (right, rows[~below])]
        return out


def _bytes(x: np.ndarray) -> bytes:
    """A matrix of doubles column by column, which packs better."""
    return np.ascontiguousarray(x.T, dtype="<f8").tobytes()


def _rows(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(-1, n).T if n else np.empty((0, 0))


def _list(values: pa.Array | pa.ChunkedArray) -> pa.Array:
    """All values as one list."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """One row."""
    cells = [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array([columns[f.name]]) for f in schema]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cells, schema)], schema=schema)


def _search_block(k: int, p: int, keep: Callable[..., Iterator[pa.RecordBatch]]):
    """Over the blocks of one task, training rows and visitors: what ``keep`` makes of the visitors and their nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visitors, rows_here, block = [], [], 0
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            for i in range(batch.num_rows):
                block, is_visit = columns["block"][i].as_py(), columns["tests"][i].is_valid
                keys, more = columns["tests" if is_visit else "trains"][i].values, columns["bound" if is_visit else "label"][i]
                (visitors if is_visit else rows_here).append(
                    (keys, _rows(columns["x"][i].as_py(), len(keys)), np.frombuffer(more.as_py(), "<f8") if more.is_valid else np.full(len(keys), np.inf)))
        if not visitors:
            return
        tests, a, bound = (_joined(column) for column in zip(*visitors))
        visitors.clear()
        if rows_here:
            trains, b, label = (_joined(column) for column in zip(*rows_here))
            rows_here.clear()
            # In key order the lower row is the smaller key.
            order = pc.sort_indices(trains).to_numpy()
            rows, hits, d = _nearest(a, b[order], k, p, bound)
            hits = order[hits]
            trains, label = trains.take(pa.array(hits)), label[hits]
        else:
            trains, label, rows, d = columns["trains"].values[:0], np.empty(0), np.empty(0, np.int64), np.empty(0)
        yield from keep(block, tests, a, rows, trains, label, d)

    return run


def _joined(parts: Sequence) -> pa.Array | np.ndarray:
    return pa.concat_arrays(parts) if isinstance(parts[0], pa.Array) else np.ascontiguousarray(np.concatenate(parts))


def _array_of(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    if isinstance(df.schema[column].dataType, VectorUDT):
        return vector_to_array(c)
    return c.cast("array<double>")


class _Settings(Params):
    state = Param(Params._dummy(), "state", "settings as JSON", TypeConverters.toString)

    @property
    def settings(self) -> dict:
        return json.loads(self.getOrDefault("state"))


class KNNClassifier(Estimator, _Settings, MLReadable, DefaultParamsWritable):
    """k nearest neighbours with uniform or distance weights, p = 1 (Manhattan) or 2 (Euclidean).

    ``featuresCol`` is an ML vector or a numeric array. ``key_col`` must be unique in the training table and
    in the test table; ties in distance go to the smaller training key.

    ``rows_per_pivot`` sets how few training rows a cell may hold on average (there are no more cells than keep all cores busy and
    hold ``CELL_BYTES`` each), ``max_pivots`` how many boxes of cells reach the driver and the tasks, ``block_rows`` for how few
    visitors a block of a cell is read again. None of them changes the result.
    """

    def __init__(self, k: int = 5, weights: str = "uniform", p: int = 2, key_col: str | None = None,
                 featuresCol: str = "features", labelCol: str = "label", block_rows: int = 8192,
                 rows_per_pivot: int = 8192, max_pivots: int = 4096):
        super().__init__()
        if weights not in ("uniform", "distance"):
            raise ValueError(f"unknown weights {weights!r}")
        if p not in (1, 2):
            raise ValueError("p must be 1 or 2")
        if k < 1:
            raise ValueError("k must be at least 1")
        if key_col is None:
            raise ValueError("knn needs key_col, a unique row key")
        self._set(state=json.dumps({"k": k, "weights": weights, "p": p, "key_col": key_col, "featuresCol": featuresCol,
                         "labelCol": labelCol, "block_rows": block_rows, "rows_per_pivot": rows_per_pivot,
                         "max_pivots": max_pivots}))

    @classmethod
    def read(cls) -> MLReader:
        return _KNNReader(lambda settings, path: cls(**settings))

    def _fit(self, train: DataFrame) -> KNNModel:
        s = self.settings
        table = train.select(F.col(s["key_col"]).alias("train_key"),
                             F.col(s["labelCol"]).cast("double").alias("label"),
                             _array_of(train, s["featuresCol"]).alias("x"))
        return KNNModel(materialise(table, "knn"), s)


class KNNModel(Model, _Settings, MLReadable, MLWritable):
    def __init__(self, table: DataFrame, settings: dict):
        super().__init__()
        self.table = table
        self._set(state=json.dumps(settings))

    # --- neighbours -------------------------------------------------------------------------------------

    def neighbours(self, test: DataFrame, k: int | None = None) -> DataFrame:
        """(test_key, rank, train_key, label, distance): the k nearest training rows of each test row."""
        s = self.settings
        k, p = k or s["k"], s["p"]
        n = self.table.count()
        if n < k:
            raise ValueError(f"{k} neighbours wanted, but only {n} training rows")
        row_bytes = 8 * len(self.table.select("x").first()["x"])
        cores = self.table.sparkSession.sparkContext.defaultParallelism
        # Cuts are learnt from rows spread by hash; a bounded number of them reaches the driver.
        wanted = max(1, min(s["max_pivots"], n // s["rows_per_pivot"], max(2 * cores, -(-n * row_bytes // CELL_BYTES))))
        picked = self.table.orderBy(F.xxhash64("train_key"), "train_key").select("x").limit(max(1024, 32 * wanted) if wanted > 1 else 1)
        cells = _Cells(_matrix(picked.toArrow()["x"]), wanted)
        sizes, lows, highs = self._boxes(cells)
        # A cell of more than CELL_BYTES is several blocks, alike in their box.
        blocks = np.maximum(1, -(-sizes * row_bytes // CELL_BYTES))
        cell_of = np.repeat(np.arange(cells.n), blocks)
        first, count = np.cumsum(blocks) - blocks, len(cell_of)
        lows, highs = lows[cell_of], highs[cell_of]

        types = {"test": test.schema[s["key_col"]].dataType, "train": self.table.schema["train_key"].dataType}
        visit = T.StructType([T.StructField("block", T.LongType()), T.StructField("no", T.LongType()), T.StructField("n", T.LongType()),
                              T.StructField("tests", T.ArrayType(types["test"])), T.StructField("x", T.BinaryType()), T.StructField("bound", T.BinaryType())])
        visit_schema, piece = to_arrow_schema(visit), max(1, min(PIECE_ROWS, s["block_rows"]))

        def pieces(block: int, no: int, keys: pa.Array, x: np.ndarray, bound: np.ndarray | None) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(x), piece):
                part = slice(at, at + piece)
                yield _record(visit_schema, block=block, no=no + at // piece, n=len(x[part]), tests=_list(keys[part]), x=_bytes(x[part]),
                              bound=pa.array([None if bound is None else bound[part].tobytes()], pa.binary()))

        def go_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            no = TaskContext.get().partitionId()
            for batch in batches:
                x = _matrix(batch.column("x"))
                home = cells.of(x) if batch.num_rows else np.empty(0, int)
                for cell in np.unique(home):
                    rows = np.flatnonzero(home == cell)
                    yield from pieces(int(first[cell] + (no * 2654435761 >> 16) % blocks[cell]), no, batch.column("test_key").take(pa.array(rows)), x[rows], None)
                    no += -(-len(rows) // piece)

        tests = test.select(F.col(s["key_col"]).alias("test_key"), _array_of(test, s["featuresCol"]).alias("x"))
        visits = materialise(tests.mapInArrow(go_home, visit), "knn-test")
        pairs = T.StructType([T.StructField("test_key", types["test"]), T.StructField("train_key", types["train"]),
                              T.StructField("label", T.DoubleType()), T.StructField("distance", T.DoubleType())])
        pair_schema = to_arrow_schema(pairs)

        def as_pairs(keys, trains, label, d) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip((keys, trains, pa.array(label), pa.array(d)), pair_schema)], schema=pair_schema)

        def only_pairs(_block, tests, _x, rows, trains, label, d) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(rows), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield as_pairs(tests.take(pa.array(rows[part])), trains[part], label[part], d[part])

        if count == 1:
            return _top_k(self._meet(visits, cells, first, blocks, row_bytes, _search_block(k, p, only_pairs), pairs), k)

        home = T.StructType([T.StructField("tests", T.ArrayType(types["test"])), T.StructField("x", T.BinaryType()), T.StructField("bound", T.BinaryType()),
                             T.StructField("home", T.LongType()), T.StructField("rows", T.BinaryType()), T.StructField("trains", T.ArrayType(types["train"])),
                             T.StructField("label", T.BinaryType()), T.StructField("distance", T.BinaryType())])
        home_schema = to_arrow_schema(home)

        def with_bound(block, tests, x, rows, trains, label, d) -> Iterator[pa.RecordBatch]:
            per_row = np.bincount(rows, minlength=len(x))
            ends = np.cumsum(per_row)
            bound = np.where(per_row >= k, d[np.maximum(ends - 1, 0)] if len(d) else np.inf, np.inf)
            for at in range(0, len(x), 4 * PIECE_ROWS):
                part = slice(at, at + 4 * PIECE_ROWS)
                hits = slice(ends[at] - per_row[at], ends[min(len(x), part.stop) - 1])
                yield _record(home_schema, tests=_list(tests[part]), x=_bytes(x[part]), bound=bound[part].tobytes(), home=block, rows=(rows[hits] - at).astype("<i8").tobytes(),
                              trains=_list(trains[hits]), label=label[hits].tobytes(), distance=d[hits].tobytes())

        at_home = materialise(self._meet(visits, cells, first, blocks, row_bytes, _search_block(k, p, with_bound), home), "knn-home")

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    rows, label, d = (np.frombuffer(batch.column(c)[i].as_py(), kind) for c, kind in (("rows", "<i8"), ("label", "<f8"), ("distance", "<f8")))
                    yield as_pairs(batch.column("tests")[i].values.take(pa.array(rows)), batch.column("trains")[i].values, label, d)

        def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            no = TaskContext.get().partitionId()
            for batch in batches:
                for i in range(batch.num_rows):
                    keys, bound = batch.column("tests")[i].values, np.frombuffer(batch.column("bound")[i].as_py(), "<f8")
                    x, at = _rows(batch.column("x")[i].as_py(), len(keys)), batch.column("home")[i].as_py()
                    limit = _widened(bound)
                    for block in range(count):
                        if block != at and lows[block][0] <= highs[block][0]:
                            rows = np.flatnonzero(_box_distances(x, x, lows[block], highs[block], p) <= limit)
                            if len(rows):
                                yield from pieces(block, no, keys.take(pa.array(rows)), x[rows], bound[rows])
                                no += -(-len(rows) // piece)

        further = materialise(at_home.select("tests", "x", "bound", "home").mapInArrow(go_on, visit), "knn-visits")
        found = at_home.select("tests", "rows", "trains", "label", "distance").mapInArrow(unpack, pairs)
        return _top_k(found.unionByName(self._meet(further, cells, first, blocks, row_bytes, _search_block(k, p, only_pairs), pairs)), k)

    def _boxes(self, cells: _Cells) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and box of each cell; a task sends a row per cell."""
        schema = pa.schema([("cell", pa.int64()), ("n", pa.int64()), ("low", pa.binary()), ("high", pa.binary())])

        def merge(parts) -> dict[int, list]:
            out: dict[int, list] = {}
            for cell, n, low, high in parts:
                was = out.get(cell)
                out[cell] = [n, low, high] if was is None else [was[0] + n, np.minimum(was[1], low), np.maximum(was[2], high)]
            return out

        def send(merged: dict[int, list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(merged), pa.int64()), pa.array([v[0] for v in merged.values()], pa.int64()),
                                               *(pa.array([v[i].tobytes() for v in merged.values()], pa.binary()) for i in (1, 2))], schema=schema)

        def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def parts():
                for batch in batches:
                    x = _matrix(batch.column("x"))
                    mine = cells.of(x) if len(x) else np.empty(0, int)
                    for cell in np.unique(mine):
                        rows = x[mine == cell]
                        yield int(cell), len(rows), *_box(rows)

            yield send(merge(parts()))

        def read(rows):
            return ((r["cell"], r["n"], *(np.frombuffer(r[c], "<f8") for c in ("low", "high"))) for r in rows)

        def of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield send(merge(r for batch in batches for r in read(batch.to_pylist())))

        kind = "cell long, n long, low binary, high binary"
        parts = self.table.select("x").mapInArrow(of_rows, kind)
        merged = merge(read(parts.repartition(max(1, cells.n // 64), "cell").mapInArrow(of_parts, kind).collect()))
        d = len(next(iter(merged.values()))[1])
        sizes, lows, highs = np.zeros(cells.n, np.int64), np.full((cells.n, d), np.inf), np.full((cells.n, d), -np.inf)
        for cell, (n, low, high) in merged.items():
            sizes[cell], lows[cell], highs[cell] = n, low, high
        return sizes, lows, highs

    def _meet(self, visits: DataFrame, cells: _Cells, first: np.ndarray, blocks: np.ndarray, row_bytes: int, search, schema: T.StructType) -> DataFrame:
        """What ``search`` returns for each block of training rows and each group of its visitors, one of both to a task."""
        cores = visits.sparkSession.sparkContext.defaultParallelism
        counts = {r["block"]: r["n"] for r in visits.groupBy("block").agg(F.sum("n").alias("n")).collect()}
        least = max(-(-sum(counts.values()) // (3 * cores)), min(self.settings["block_rows"], 4 * PIECE_ROWS))
        each = max(1, min(least, CELL_BYTES // max(1, row_bytes)))
        groups = np.array([-(-counts.get(i, 0) // each) for i in range(int(blocks.sum()))])
        starts, total = np.cumsum(groups) - groups, max(1, int(groups.sum()))

        def at(values: Sequence[int]) -> Column:
            return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), (F.col("block") + 1).cast("int"))

        train = T.StructType([T.StructField("block", T.LongType()), T.StructField("trains", T.ArrayType(self.table.schema["train_key"].dataType)),
                              T.StructField("x", T.BinaryType()), T.StructField("label", T.BinaryType())])
        train_schema = to_arrow_schema(train)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column("x"))
                mine = cells.of(x) if len(x) else np.empty(0, int)
                mine = first[mine] + np.arange(len(x)) % blocks[mine]
                label = batch.column("label").to_numpy(zero_copy_only=False).astype("<f8")
                for block in np.unique(mine):
                    rows = np.flatnonzero(mine == block)
                    yield _record(train_schema, block=int(block), trains=_list(batch.column("train_key").take(pa.array(rows))), x=_bytes(x[rows]), label=label[rows].tobytes())

        dealt = self.table.select("train_key", "label", "x").mapInArrow(deal, train).filter(at(groups) > 0)
        left = visits.select((at(starts) + F.pmod("no", at(groups))).alias("group"), "block", "tests", "x", "bound")
        right = dealt.select(F.explode(F.sequence(at(starts), at(starts) + at(groups) - 1)).alias("group"), "block", "trains", "x", "label")
        both = left.unionByName(right, allowMissingColumns=True).withColumn("group", F.col("group").cast("int"))
        return both.repartitionById(total, "group").mapInArrow(search, schema)

    # --- votes ------------------------------------------------------------------------------------------

    def _transform(self, test: DataFrame) -> DataFrame:
        """Add ``probability`` (vector of two) and ``prediction``."""
        s = self.settings
        voted = vote(self.neighbours(test), s["k"], s["weights"])
        out = voted.select(F.col("test_key").alias("__knn_key"),
                           array_to_vector(F.array(1.0 - F.col("score"), F.col("score"))).alias("probability"),
                           "prediction")
        return test.join(out, F.col(s["key_col"]) == F.col("__knn_key")).drop("__knn_key")

    def write(self) -> MLWriter:
        return _KNNWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _KNNReader(lambda settings, path: cls(SparkSession.active().read.parquet(f"{path}/table"), settings))

    def release(self) -> None:
        """Delete the written training rows."""
        release(self.table)


class _KNNWriter(MLWriter):
    """Settings as metadata, training rows as a Parquet table."""

    def __init__(self, model: KNNModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.parquet(f"{path}/table")


class _KNNReader(MLReader):
    def __init__(self, build):
        super().__init__()
        self.build = build

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        made = self.build(json.loads(metadata["paramMap"]["state"]), path)
        made._resetUid(metadata["uid"])
        return made


def _top_k(found: DataFrame, k: int) -> DataFrame:
    """Per test row the k nearest of its candidates, of which there are at most k per visited block."""
    nearest = Window.partitionBy("test_key").orderBy("distance", "train_key")
    ranked = found.select("test_key", F.row_number().over(nearest).alias("rank"), "train_key", "label", "distance")
    return ranked.filter(F.col("rank") <= k)


def vote(neighbours: DataFrame, k: int, weights: str = "uniform") -> DataFrame:
    """(test_key, prediction, score) from the first k neighbours.

    ``distance`` weighs by 1/d; if any of the k lies at distance 0, only those vote. A tie goes to the
    smaller label. ``score`` is the share of label 1.
    """
    return vote_many(neighbours, [(0, k, weights)]).drop("point")


def vote_many(neighbours: DataFrame, points: Sequence[tuple[int, int, str]]) -> DataFrame:
    """(test_key, point, prediction, score) for each (point, k, weights), as ``vote`` has them for one, in one pass over the neighbours."""
    # The nearest of a row is among the first k for any k.
    touching = F.min("distance").over(Window.partitionBy("test_key")) == 0
    by_distance = F.when(touching, F.when(F.col("distance") == 0, 1.0).otherwise(0.0)).otherwise(1.0 / F.nullif(F.col("distance"), F.lit(0.0)))
    weighed = neighbours.select("test_key", "rank", "label", by_distance.alias("by_distance")) if any(w == "distance" for _, _, w in points) else (
        neighbours.select("test_key", "rank", "label", F.lit(1.0).alias("by_distance")))
    ballots = F.array(*[F.struct(F.lit(i).alias("point"), F.lit(k).alias("k"), (F.lit(1.0) if w == "uniform" else F.col("by_distance")).alias("w")) for i, k, w in points])
    shares = (weighed.select("test_key", "label", F.explode(F.filter(ballots, lambda b: F.col("rank") <= b["k"])).alias("b"))
              .groupBy("test_key", F.col("b.point").alias("point"), "label").agg(F.sum("b.w").alias("w")))
    best = F.max(F.struct(F.round("w", 9).alias("w"), (-F.col("label")).alias("minus_label")))
    return shares.groupBy("test_key", "point").agg(
        (-best["minus_label"] + 0.0).alias("prediction"),
        (F.sum(F.when(F.col("label") == 1, F.col("w")).otherwise(0.0)) / F.sum("w")).alias("score"))
