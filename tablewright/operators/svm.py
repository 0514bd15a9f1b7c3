"""Linear support vector classifier with squared hinge loss and an L1 or L2 penalty.

It minimises ``penalty(w) + C * sum of max(0, 1 - y * (w.x + b))^2`` with y = -1 or 1, where the penalty is half the squared length
or the sum of absolute weights, the intercept included as the weight of a constant feature.

The loss is smooth, so Newton steps settle in some ten passes. A pass is one aggregate of fixed size per task: loss,
gradient and curvature over the rows inside the margin, an array of d + d * d numbers a task, added up in groups of tasks where there are many. The step for d weights is worked out on the
driver: a linear system for L2, coordinate descent on the quadratic model for L1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasRawPredictionCol, HasTol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.blocks import sum_parts

PENALTIES = ("l1", "l2")


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol):
    pass


def loss_sums(rows: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature of the squared hinge at ``weights``, summed over all rows."""
    d = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + d + d * d)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            x = np.hstack([x, np.ones((len(x), 1))])
            y = np.where(batch.column("y").to_numpy(zero_copy_only=False) > 0, 1.0, -1.0)
            gap = 1 - y * (x @ weights)
            inside = gap > 0
            x, y, gap = x[inside], y[inside], gap[inside]
            total[0] += (gap ** 2).sum()
            total[1:1 + d] -= 2 * x.T @ (y * gap)
            total[1 + d:] += 2 * (x.T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["part"])

    total = sum_parts(rows.mapInArrow(run, "part binary"), 1 + d + d * d)
    return total[0], total[1:1 + d], total[1 + d:].reshape(d, d)


def _l1_step(weights: np.ndarray, gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """Minimum of the quadratic model plus the sum of absolute weights, by coordinate descent."""
    goal, slope = weights.copy(), gradient.copy()  # slope: gradient of the model at ``goal``
    for _ in range(1000):
        moved = 0.0
        for j in range(len(goal)):
            bend = curvature[j, j]
            if bend <= 0:
                continue
            pull = goal[j] - slope[j] / bend
            new = np.sign(pull) * max(abs(pull) - 1 / bend, 0.0)
            if new != goal[j]:
                slope += curvature[:, j] * (new - goal[j])
                moved = max(moved, abs(new - goal[j]))
                goal[j] = new
        if moved <= 1e-12 * max(1.0, np.abs(goal).max()):
            break
    return goal - weights


def residual(weights: np.ndarray, gradient: np.ndarray, penalty: str) -> float:
    """Largest violation of the optimality conditions; ``gradient`` is that of the weighted loss."""
    if penalty == "l2":
        return float(np.abs(weights + gradient).max())
    zero = weights == 0
    return float(np.where(zero, np.maximum(np.abs(gradient) - 1, 0), np.abs(gradient + np.sign(weights))).max())


class SquaredHingeSVC(Estimator, _Columns, HasMaxIter, HasTol, DefaultParamsReadable, DefaultParamsWritable):
    """``C`` weighs the summed loss. Fitting ends when the optimality residual is below ``tol`` times that of zero weights."""

    C = Param(Params._dummy(), "C", "weight of the loss", TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "l1 or l2", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, C=1.0, penalty="l2", maxIter=1000, tol=1e-4, featuresCol="features", labelCol="label",
                 predictionCol="prediction", rawPredictionCol="rawPrediction"):
        super().__init__()
        if penalty not in PENALTIES:
            raise ValueError(f"unknown penalty {penalty!r}")
        self._setDefault(C=1.0, penalty="l2", maxIter=1000, tol=1e-4)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SquaredHingeSVCModel:
        c, penalty = self.getOrDefault("C"), self.getOrDefault("penalty")
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        first = rows.first()
        if first is None:
            raise ValueError("no rows to fit")

        def worth(weights, loss):
            return c * loss + (0.5 * weights @ weights if penalty == "l2" else np.abs(weights).sum())

        weights = np.zeros(len(first["x"]) + 1)
        loss, gradient, curvature = loss_sums(rows, weights)
        start = residual(weights, c * gradient, penalty) or 1.0
        for _ in range(self.getMaxIter()):
            if residual(weights, c * gradient, penalty) <= self.getTol() * start:
                break
            if penalty == "l2":
                step = -np.linalg.solve(c * curvature + np.eye(len(weights)), weights + c * gradient)
            else:
                step = _l1_step(weights, c * gradient, c * curvature + 1e-10 * np.eye(len(weights)))
            now, size = worth(weights, loss), 1.0
            while True:
                trial = weights + size * step
                found = loss_sums(rows, trial)
                if worth(trial, found[0]) <= now or size < 1e-6:
                    break
                size /= 2
            if worth(trial, found[0]) > now:
                break
            stalled = now - worth(trial, found[0]) <= 1e-12 * abs(now)
            weights, (loss, gradient, curvature) = trial, found
            if stalled:
                break
        model = SquaredHingeSVCModel(weights[:-1].tolist(), float(weights[-1]))
        return self._copyValues(model)


class SquaredHingeSVCModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Decision values in ``rawPrediction`` as (-value, value); class 1 where the value is positive."""

    weights = Param(Params._dummy(), "weights", "weight of each feature", TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "weight of the constant feature", TypeConverters.toFloat)

    def __init__(self, weights=None, offset=None):
        super().__init__()
        if weights is not None:
            self._set(weights=weights, offset=offset)

    @property
    def coefficients(self):
        from pyspark.ml.linalg import DenseVector

        return DenseVector(self.getOrDefault("weights"))

    @property
    def intercept(self) -> float:
        return self.getOrDefault("offset")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(w) for w in self.getOrDefault("weights")])
        products = F.zip_with(vector_to_array(self.getFeaturesCol()), weights, lambda x, w: x * w)
        value = F.aggregate(products, F.lit(self.getOrDefault("offset")), lambda total, v: total + v)
        scored = dataset.withColumn("__value", value)
        raw = array_to_vector(F.array(-F.col("__value"), F.col("__value")))
        return scored.withColumn(self.getRawPredictionCol(), raw).withColumn(
            self.getPredictionCol(), (F.col("__value") > 0).cast("double")).drop("__value")
