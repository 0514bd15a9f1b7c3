"""Registry of the classifiers, their parameter names and grids, saving and loading."""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame

from tablewright.operators.boosting import SecondOrderBoosting
from tablewright.operators.deep_trees import DeepForest
from tablewright.operators.knn import KNNClassifier
from tablewright.operators.svm import SquaredHingeSVC

SUPPORTED_MODELS = ("logistic_regression", "svm", "decision_tree", "random_forest", "xgboost", "knn")

# Spark's trees are at most 30 deep; ``max_depth=None`` grows trees without a limit.
TREE_DEPTH_LIMIT = 30

# The search grids, in the parameter names of the factory below.
PARAM_GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"C": [0.001, 0.01, 0.1, 1, 10, 100]},
    "svm": {"penalty": ["l1", "l2"], "C": [0.1, 1, 10, 100]},
    "decision_tree": {"criterion": ["gini", "entropy"], "max_depth": [None, 5, 10, 20],
                      "min_samples_leaf": [1, 2, 4]},
    "random_forest": {"n_estimators": [50, 100], "max_depth": [None, 10], "min_samples_leaf": [1, 2]},
    "xgboost": {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1, 0.2], "max_depth": [3, 5, 7],
                "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0]},
    "knn": {"n_neighbors": [3, 5, 7, 9, 11], "weights": ["uniform", "distance"], "p": [1, 2]},
}

# Parameters that stay on through tuning and the final fit.
BASE_PARAMS: dict[str, dict] = {
    "logistic_regression": {"max_iter": 1000},
    "svm": {"max_iter": 5000},
}


def param_grid(name: str) -> list[dict]:
    """Every combination of the model's grid."""
    if name not in PARAM_GRIDS:
        raise ValueError(f"no parameter grid for model {name!r}")
    return expand_grid(PARAM_GRIDS[name])


def expand_grid(grid: Mapping[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def draw_from_grid(combinations: list[dict], n_iter: int = 10, seed: int = 42) -> list[dict]:
    """Seeded draw without replacement; the whole grid if it is no larger than ``n_iter``."""
    if len(combinations) <= n_iter:
        return list(combinations)
    return random.Random(seed).sample(combinations, n_iter)


def _regularisation(p: dict, n_rows: int) -> float:
    # C weighs the summed loss, regParam the penalty against the mean loss.
    return 1.0 / (p.pop("C", 1.0) * max(n_rows, 1))


def _depth(p: dict, default: int | None, unlimited: int | None = None) -> int | None:
    """``max_depth``, or what stands for no limit; an explicit depth that Spark cannot grow is an error."""
    depth = p.pop("max_depth", default)
    depth = unlimited if depth is None else int(depth)
    if depth is not None and depth > TREE_DEPTH_LIMIT:
        raise ValueError(f"max_depth {depth} is over the limit of {TREE_DEPTH_LIMIT}")
    return depth


def build_model(name: str, n_rows: int, features_col: str = "features", label_col: str = "label",
                key_col: str | None = None, **params):
    """Estimator for a model name; ``n_rows`` is the size of the training table.

    Unknown names and unknown parameters are errors. Every model but kNN has the seed 42 unless
    ``random_state`` says otherwise.
    """
    if name not in SUPPORTED_MODELS:
        raise ValueError(f"unsupported model {name!r}")
    p = {**BASE_PARAMS.get(name, {}), **params}
    seed = p.pop("random_state", 42)
    columns = {"featuresCol": features_col, "labelCol": label_col}
    if name == "knn":
        model = KNNClassifier(k=p.pop("n_neighbors", 5), weights=p.pop("weights", "uniform"), p=p.pop("p", 2),
                              key_col=key_col, **columns)
    elif name == "logistic_regression":
        model = LogisticRegression(regParam=_regularisation(p, n_rows), elasticNetParam=0.0, standardization=False,
                                   maxIter=p.pop("max_iter", 100), tol=p.pop("tol", 1e-4),
                                   family="binomial", **columns)
    elif name == "svm":
        model = SquaredHingeSVC(C=float(p.pop("C", 1.0)), penalty=p.pop("penalty", "l2"),
                                maxIter=p.pop("max_iter", 1000), tol=p.pop("tol", 1e-4), **columns)
    elif name in ("decision_tree", "random_forest"):
        forest = name == "random_forest"
        depth = _depth(p, None, p.pop("unlimited_depth", None) if forest else None)
        shared = {"impurity": p.pop("criterion", "gini"), "minInstancesPerNode": p.pop("min_samples_leaf", 1), "seed": seed, **columns}
        n_trees = p.pop("n_estimators", 100) if forest else 1
        if depth is None:
            model = DeepForest(numTrees=n_trees, bootstrap=forest, columnsPerNode="sqrt" if forest else "all",
                               subtreeRows=p.pop("subtree_rows", 1 << 18), **shared)
        elif forest:
            model = RandomForestClassifier(numTrees=n_trees, maxDepth=depth, maxBins=64, maxMemoryInMB=1024, **shared)
        else:
            model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, maxMemoryInMB=512, **shared)
    else:
        model = SecondOrderBoosting(
            maxIter=p.pop("n_estimators", 100), stepSize=p.pop("learning_rate", 0.3), maxDepth=_depth(p, 6, TREE_DEPTH_LIMIT),
            subsamplingRate=float(p.pop("subsample", 1.0)), columnsPerTree=float(p.pop("colsample_bytree", 1.0)),
            regLambda=float(p.pop("reg_lambda", 1.0)), gamma=float(p.pop("gamma", 0.0)), minChildWeight=float(p.pop("min_child_weight", 1.0)),
            maxBins=64, seed=seed, **columns)
    if p:
        raise ValueError(f"unknown parameters for {name}: {sorted(p)}")
    return model


def train_model(estimator, train: DataFrame):
    if estimator is None:
        raise ValueError("no model to train")
    return estimator.fit(train)


def predict(model, test: DataFrame) -> DataFrame:
    if model is None:
        raise ValueError("no model to predict with")
    return model.transform(test)


def save_model(model, folder: str, name: str) -> str | None:
    """Save under folder/name; nothing happens without a model."""
    if model is None:
        return None
    path = f"{folder.rstrip('/')}/{name}"
    PipelineModel([model]).write().overwrite().save(path)
    return path


def load_model(spark, folder: str, name: str) -> Model:
    """A saved model says itself what it is; its name is free."""
    return PipelineModel.load(f"{folder.rstrip('/')}/{name}").stages[0]
