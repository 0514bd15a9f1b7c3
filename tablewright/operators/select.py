"""Wrapper feature selection: recursive elimination and sequential forward or backward search."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.deep_trees import DeepForest
from tablewright.operators.split import mark_folds
from tablewright.operators.tune import f1_evaluator

METHODS = ("rfe", "forward", "backward")


def assemble(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """(features, label, kept columns): the feature vector is assembled once, in double."""
    base = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)],
                     F.col(f"`{label}`").cast("double").alias("label"), *keep)
    assembler = VectorAssembler(inputCols=[f"f{i}" for i in range(len(features))], outputCol="features",
                                handleInvalid="error")
    return assembler.transform(base).select("features", "label", *keep)


def default_base_model(max_depth: int | None = None):
    """A forest of 100 trees, without a limit of depth unless one is given."""
    if max_depth is None:
        return DeepForest(numTrees=100, bootstrap=True, columnsPerNode="sqrt", seed=42, featuresCol="chosen", labelCol="label")
    return RandomForestClassifier(numTrees=100, maxDepth=max_depth, seed=42, maxBins=64, maxMemoryInMB=1024,
                                  featuresCol="chosen", labelCol="label")


def _on_chosen(base_model, indices: Sequence[int]):
    slicer = VectorSlicer(inputCol="features", outputCol="chosen", indices=list(indices))
    return slicer, base_model.copy({base_model.featuresCol: "chosen", base_model.labelCol: "label"})


def _importances(model) -> np.ndarray:
    """Importances of a tree model, squared coefficients of a linear one."""
    if hasattr(model, "featureImportances"):
        return model.featureImportances.toArray()
    if hasattr(model, "coefficients"):
        return model.coefficients.toArray() ** 2
    raise ValueError(f"{type(model).__name__} has neither importances nor coefficients")


def _eliminate(data: DataFrame, n_all: int, n_keep: int, base_model) -> list[int]:
    chosen = list(range(n_all))
    while len(chosen) > n_keep:
        slicer, estimator = _on_chosen(base_model, chosen)
        weights = _importances(estimator.fit(slicer.transform(data)))
        chosen.pop(int(np.argmin(weights)))
    return chosen


def _f1_by_folds(data: DataFrame, indices: Sequence[int], base_model, n_folds: int) -> float:
    slicer, estimator = _on_chosen(base_model, indices)
    sliced, scores = slicer.transform(data), []
    for fold in range(n_folds):
        model = estimator.fit(sliced.filter(F.col("fold") != fold))
        scores.append(f1_evaluator().evaluate(model.transform(sliced.filter(F.col("fold") == fold))))
    return sum(scores) / n_folds


def _sequential(data: DataFrame, n_all: int, n_keep: int, base_model, forward: bool, n_folds: int,
                parallelism: int) -> list[int]:
    """Add the best (or drop the least missed) feature until ``n_keep`` are chosen; the candidates of a
    step are independent jobs of a small thread pool."""
    chosen = [] if forward else list(range(n_all))
    score = inheritable_thread_target(data.sparkSession)(
        lambda trial: _f1_by_folds(data, trial, base_model, n_folds))
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        while len(chosen) != n_keep:
            options = [i for i in range(n_all) if i not in chosen] if forward else list(chosen)
            trials = [sorted([*chosen, i]) if forward else [j for j in chosen if j != i] for i in options]
            scores = list(pool.map(score, trials))
            chosen = trials[max(range(len(trials)), key=scores.__getitem__)]
    return chosen


def select_features(df: DataFrame, features: Sequence[str], label: str, method: str = "rfe", n_features: int = 15,
                    base_model=None, key: Sequence[str] = (), n_folds: int = 3, seed: int = 42,
                    parallelism: int = 8) -> list[str]:
    """Names of the chosen features, in table order.

    ``base_model`` is any Spark classifier with importances or coefficients (rfe), or any classifier
    (forward, backward). The sequential methods need ``key``, unique per row, for their stratified folds.
    """
    if method not in METHODS:
        raise ValueError(f"unknown feature selection method {method!r}")
    features = list(features)
    if n_features >= len(features):
        return features
    if n_features < 1:
        raise ValueError("n_features must be at least 1")
    base_model = base_model or default_base_model()
    if method == "rfe":
        data = assemble(df, features, label)
    else:
        if not key:
            raise ValueError(f"{method} selection needs a unique key for its folds")
        folded = mark_folds(df, key, n_folds, stratify_by=label, seed=seed, out="fold")
        data = assemble(folded, features, label, ["fold"])
    # Read by every fit below; blocks of a lost executor are computed again from the table behind it.
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if method == "rfe":
            chosen = _eliminate(data, len(features), n_features, base_model)
        else:
            chosen = _sequential(data, len(features), n_features, base_model, method == "forward", n_folds, parallelism)
    finally:
        data.unpersist()
    return [features[i] for i in chosen]
