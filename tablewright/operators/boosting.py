"""Second-order gradient boosting of trees on binned features.

Features are coded once, to the number of the bin between quantile cuts, one byte a cell; a missing cell (NULL or NaN in the vector's array) is a bin of its own. A level of a tree
is one pass over the codes: every task sums gradient and curvature of the log loss per (node, feature, bin), for the smaller child of each split only, since its sibling is the
parent less it. The sums of the tasks are added up in Spark, and their size does not depend on the rows. The driver picks for each node the cut, and the side of its missing cells, of the
greatest gain

    (GL^2 / (HL + lambda) + GR^2 / (HR + lambda) - G^2 / (H + lambda)) / 2 - gamma

and a leaf weighs ``-G / (H + lambda)`` times the learning rate. Columns are drawn per tree, rows per tree by a generator that is seeded by block and tree, so a block that is
computed again draws the same rows.

Codes and margins are written to the shared folder every ``REFRESH`` trees: tasks add the trees since then to the margin as they read, and no lineage grows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasSeed, HasStepSize,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import Scratch, materialise

MISSING = 255
REFRESH = 20
#: Tasks whose sums the driver may add up itself; more are added up in groups first.
DIRECT = 64
#: Blocks of less than this share a task: a pass over them takes less time than a task does.
TASK_BYTES = 1 << 20


def cut_points(values: DataFrame, n_features: int, bins: int) -> list[np.ndarray]:
    """Ascending distinct cuts per feature: about ``bins`` quantiles; a value up to a cut falls into its bin, the largest value is no cut. One aggregate."""
    shares = [(i + 1) / bins for i in range(bins)]
    cell = [F.get("x", F.lit(j)) for j in range(n_features)]
    found = values.agg(*[F.percentile_approx(F.when(~F.isnan(c), c), shares, 20 * bins).alias(f"q{j}") for j, c in enumerate(cell)],
                       *[F.max(F.when(~F.isnan(c), c)).alias(f"m{j}") for j, c in enumerate(cell)]).first()
    return [np.array(sorted({q for q in found[f"q{j}"] or () if q < found[f"m{j}"]})) for j in range(n_features)]


def code_rows(values: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``block``, ``codes`` (a byte per cell), ``y`` and ``margin`` (64-bit floats): the rows of each Arrow batch as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            codes = np.stack([np.where(np.isnan(c), MISSING, np.searchsorted(cut, c)) for c, cut in zip(x.T, cuts)], axis=1).astype(np.uint8)
            y = (batch.column("y").to_numpy(zero_copy_only=False) > 0).astype("<f8")
            yield pa.RecordBatch.from_arrays([pa.array([block]), *(pa.array([v.tobytes()]) for v in (codes, y, np.zeros(len(y))))],
                                             names=["block", "codes", "y", "margin"])
            block += 1

    return values.mapInArrow(run, "block long, codes binary, y binary, margin binary")


class Tree:
    """Splits by number of the node, the root 0: feature, code and value of the cut, side of the missing cells, children; a leaf has feature -1 and a value."""

    def __init__(self):
        self.feature, self.code, self.cut, self.missing_left, self.left, self.right, self.value, self.gain = ([] for _ in range(8))
        self.add()

    def add(self) -> int:
        for column, value in ((self.feature, -1), (self.code, 0), (self.cut, 0.0), (self.missing_left, False), (self.left, -1), (self.right, -1),
                              (self.value, 0.0), (self.gain, 0.0)):
            column.append(value)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, code: int, cut: float, missing_left: bool, gain: float) -> tuple[int, int]:
        left, right = self.add(), self.add()
        for column, value in ((self.feature, feature), (self.code, code), (self.cut, cut), (self.missing_left, missing_left), (self.left, left),
                              (self.right, right), (self.gain, gain)):
            column[node] = value
        return left, right

    def walk(self, coded: bool) -> Walk:
        """The tree as it stands, for rows of codes or of values."""
        n = len(self.feature)
        leaf, itself = np.array(self.feature) < 0, np.arange(n)
        left, right = np.where(leaf, itself, self.left), np.where(leaf, itself, self.right)
        depth = np.zeros(n, np.int64)
        for node in range(n):  # children come after their parent
            if not leaf[node]:
                depth[[self.left[node], self.right[node]]] = depth[node] + 1
        return Walk(coded, int(depth.max()), np.where(leaf, 0, self.feature), np.where(leaf, 0, self.code if coded else self.cut),
                    np.stack([right, left], axis=1).ravel(), np.where(self.missing_left, left, right), np.array(self.value))

    def nodes_of(self, rows: np.ndarray, coded: bool) -> np.ndarray:
        return self.walk(coded).nodes(rows)

    def of(self, rows: np.ndarray, coded: bool) -> np.ndarray:
        return self.walk(coded).of(rows)


@dataclass
class Walk:
    """A tree as arrays by node, small to send and quick to apply. A leaf leads to itself, so all rows take as many steps as the deepest."""

    coded: bool
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    to: np.ndarray  # by 2 * node + side, the left side last
    missing_to: np.ndarray
    value: np.ndarray

    def nodes(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        cells, first = rows.ravel(), np.arange(len(rows)) * rows.shape[1]
        any_missing = bool((cells == MISSING).any() if self.coded else np.isnan(cells).any())
        node = np.zeros(len(rows), np.int64)
        for _ in range(self.depth):
            cell = cells.take(first + self.feature.take(node))
            after = self.to.take(2 * node + (cell <= self.cut.take(node)))
            if any_missing:
                after = np.where(cell == MISSING if self.coded else np.isnan(cell), self.missing_to.take(node), after)
            node = after
        return node

    def of(self, rows: np.ndarray) -> np.ndarray:
        return self.value.take(self.nodes(rows))


def _unpack(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    y = np.frombuffer(row["y"], "<f8")
    return np.frombuffer(row["codes"], np.uint8).reshape(len(y), width), y, np.frombuffer(row["margin"], "<f8")


def _add_up(parts, size: int) -> np.ndarray:
    return sum((np.frombuffer(p) for p in parts), np.zeros(size))


class Trainer:
    """The passes over the coded blocks of one fit."""

    def __init__(self, coded: DataFrame, width: int, bins: int, subsample: float, seed: int):
        self.width, self.bins, self.subsample, self.seed = width, bins, subsample, seed
        self.scratch = Scratch(coded.sparkSession).open()
        self.recent: list[Walk] = []
        self.blocks = None
        self._keep(coded)

    def _keep(self, coded: DataFrame) -> None:
        before = self.blocks
        # Many short passes follow, whose logic is numpy over a block: tuples of bytes are read with the least overhead per pass.
        written = materialise(coded, "boosting")
        if before is None:
            size = written.agg(F.sum(F.length("codes") + F.length("y") * 2)).first()[0] or 0
            self.most_tasks = -(-size // TASK_BYTES)
        rows = written.rdd.map(lambda r: r.asDict())
        if self.most_tasks < rows.getNumPartitions():
            rows = rows.coalesce(max(1, self.most_tasks))
        self.blocks = rows.persist(StorageLevel.MEMORY_AND_DISK)
        self.tasks = self.blocks.getNumPartitions()
        if before is not None:
            before.unpersist()

    def histograms(self, tree: Tree, nodes: list[int], columns: np.ndarray, number: int) -> np.ndarray:
        """(node, column, bin, gradient or curvature) over the rows drawn for the tree, for the given nodes of it."""
        width, bins, subsample, seed, recent = self.width, self.bins, self.subsample, self.seed, list(self.recent)
        walk, n_nodes = tree.walk(True), len(tree.feature)
        shape = (len(nodes), len(columns), bins + 1, 2)

        def run(rows):
            total = np.zeros(shape)
            slot = np.full(n_nodes, -1)
            slot[nodes] = np.arange(len(nodes))
            for row in rows:
                codes, y, margin = _unpack(row, width)
                margin = margin + sum(t.of(codes) for t in recent)
                at = slot[walk.nodes(codes)]
                mine = at >= 0
                if subsample < 1:
                    mine &= np.random.default_rng([seed, number, row["block"] >> 32, row["block"] & 0xFFFFFFFF]).random(len(y)) < subsample
                p = 1 / (1 + np.exp(-margin[mine]))
                g, h, at = p - y[mine], p * (1 - p), at[mine]
                for j, column in enumerate(columns):
                    cell = at * (bins + 1) + np.minimum(codes[mine, column], bins)
                    for k, value in enumerate((g, h)):
                        total[:, j, :, k] += np.bincount(cell, value, len(nodes) * (bins + 1)).reshape(len(nodes), -1)
            yield total.tobytes()

        parts = self.blocks.mapPartitions(run)
        size = int(np.prod(shape))
        if self.tasks > DIRECT:
            parts = parts.repartition(int(self.tasks ** 0.5) + 1).mapPartitions(lambda some: [_add_up(some, size).tobytes()])
        return _add_up(parts.collect(), size).reshape(shape)

    def keep(self, tree: Tree) -> None:
        """Count the finished tree in; now and then write the margins anew."""
        self.recent.append(tree.walk(True))
        if len(self.recent) == REFRESH:
            width, recent = self.width, self.recent

            def run(row):
                codes, _, margin = _unpack(row, width)
                return {**row, "margin": (margin + sum(t.of(codes) for t in recent)).tobytes()}

            spark = self.scratch.spark
            self._keep(spark.createDataFrame(self.blocks.map(run), "block long, codes binary, margin binary, y binary"))
            self.recent = []

    def close(self) -> None:
        self.blocks.unpersist()
        self.scratch.release()


def best_splits(sums: np.ndarray, lam: float, gamma: float, least_h: float) -> list[tuple | None]:
    """Per node (gain, place of the column, code, missing cells left) of the best split with a gain above 0, or None. Ties: the first."""
    value, missing = sums[:, :, :-1], sums[:, :, -1:]
    whole = sums.sum(axis=2)[:, :, None]
    below = np.cumsum(value, axis=2)[:, :, :-1]  # nothing lies above the last bin
    if not below.shape[2]:
        return [None] * len(sums)

    def worth(s):
        return s[..., 0] ** 2 / (s[..., 1] + lam + 1e-300)

    gains = []
    for left in (below + missing, below):
        right = whole - left
        gain = (worth(left) + worth(right) - worth(whole)) / 2 - gamma
        gains.append(np.where((left[..., 1] >= least_h) & (right[..., 1] >= least_h), gain, -np.inf))
    gains = np.stack(gains, axis=-1)  # (node, column, code, side)
    found = []
    for node in gains:
        place = np.unravel_index(np.argmax(node), node.shape)
        found.append((float(node[place]), int(place[0]), int(place[1]), place[2] == 0) if node[place] > 1e-12 else None)
    return found


def grow(trainer: Trainer, number: int, columns: np.ndarray, cuts: list[np.ndarray], depth: int, rate: float, lam: float, gamma: float, least_h: float) -> Tree:
    """One tree; children get their values with the split that makes them, so the last level needs no pass."""
    def weight(sums):
        return float(-rate * sums[0] / (sums[1] + lam + 1e-300))

    tree = Tree()
    level = {0: trainer.histograms(tree, [0], columns, number)[0]}
    tree.value[0] = weight(level[0][0].sum(axis=0))
    for at in range(depth):
        pairs = []
        for (node, sums), best in zip(level.items(), best_splits(np.stack(list(level.values())), lam, gamma, least_h)):
            if best is None:
                continue
            gain, place, code, missing_left = best
            left, right = tree.split(node, int(columns[place]), code, float(cuts[columns[place]][code]), bool(missing_left), gain)
            whole = sums[place].sum(axis=0)
            lower = sums[place, :code + 1].sum(axis=0) + missing_left * sums[place, -1]
            tree.value[left], tree.value[right] = weight(lower), weight(whole - lower)
            pairs.append((left, right, sums) if lower[1] * 2 <= whole[1] else (right, left, sums))
        if not pairs or at + 1 == depth:
            break
        level = {}
        for (small, large, parent), sums in zip(pairs, trainer.histograms(tree, [p[0] for p in pairs], columns, number)):
            level[small], level[large] = sums, parent - sums
    return tree


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, HasProbabilityCol):
    pass


class SecondOrderBoosting(Estimator, _Columns, HasMaxIter, HasStepSize, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Binary classifier; rows with a label above 0 are class 1. A table without rows is an error; NaN cells are missing."""

    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, up to 255", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows drawn per tree", TypeConverters.toFloat)
    columnsPerTree = Param(Params._dummy(), "columnsPerTree", "share of the columns drawn per tree", TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "penalty on squared leaf weights", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "least gain of a split", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least curvature of a child", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, maxIter=100, stepSize=0.3, maxDepth=6, maxBins=64, subsamplingRate=1.0, columnsPerTree=1.0, regLambda=1.0, gamma=0.0,
                 minChildWeight=1.0, seed=42, featuresCol="features", labelCol="label", predictionCol="prediction", rawPredictionCol="rawPrediction",
                 probabilityCol="probability"):
        super().__init__()
        self._setDefault(maxIter=100, stepSize=0.3, maxDepth=6, maxBins=64, subsamplingRate=1.0, columnsPerTree=1.0, regLambda=1.0, gamma=0.0,
                         minChildWeight=1.0, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SecondOrderBoostingModel:
        of = self.getOrDefault
        if not 2 <= of("maxBins") <= MISSING:
            raise ValueError(f"maxBins has to be 2 to {MISSING}")
        values = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        first = values.first()
        if first is None:
            raise ValueError("no rows to fit")
        d = len(first["x"])
        cuts = cut_points(values, d, of("maxBins"))
        trainer = Trainer(code_rows(values, cuts), d, of("maxBins"), of("subsamplingRate"), of("seed"))
        rng, trees = np.random.default_rng(of("seed")), []
        try:
            for number in range(of("maxIter")):
                columns = np.sort(rng.choice(d, max(1, round(of("columnsPerTree") * d)), replace=False))
                trees.append(grow(trainer, number, columns, cuts, of("maxDepth"), of("stepSize"), of("regLambda"), of("gamma"), of("minChildWeight")))
                trainer.keep(trees[-1])
        finally:
            trainer.close()
        return self._copyValues(SecondOrderBoostingModel(json.dumps([t.__dict__ for t in trees]), d))


class SecondOrderBoostingModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """The margin in ``rawPrediction`` as (-margin, margin), its logistic in ``probability``; class 1 where it is positive."""

    forest = Param(Params._dummy(), "forest", "the trees as JSON", TypeConverters.toString)
    width = Param(Params._dummy(), "width", "number of features", TypeConverters.toInt)

    def __init__(self, forest=None, width=None):
        super().__init__()
        if forest is not None:
            self._set(forest=forest, width=width)

    @property
    def trees(self) -> list[Tree]:
        found = []
        for columns in json.loads(self.getOrDefault("forest")):
            found.append(Tree())
            found[-1].__dict__.update(columns)
        return found

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each feature in the gain of all splits."""
        total = np.zeros(self.getOrDefault("width"))
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    total[feature] += gain
        return DenseVector(total / (total.sum() or 1.0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = [t.walk(False) for t in self.trees]

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_numpy()) if len(x) else np.empty((0, 1))
            return pd.Series(sum((t.of(rows) for t in trees), np.zeros(len(rows))))

        p = 1 / (1 + F.exp(-F.col("__margin")))
        scored = dataset.withColumn("__margin", margin(vector_to_array(self.getFeaturesCol())))
        return scored.withColumn(self.getRawPredictionCol(), array_to_vector(F.array(-F.col("__margin"), F.col("__margin")))).withColumn(
            self.getProbabilityCol(), array_to_vector(F.array(1 - p, p))).withColumn(
            self.getPredictionCol(), (F.col("__margin") > 0).cast("double")).drop("__margin")
