import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tablewright.operators import blocks, logistic, tune


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 3))
    y = (rng.random(900) < 1 / (1 + np.exp(-(x @ [2, -1, 0] + 0.5)))).astype(float)
    rows = [(Vectors.dense(a), float(b), i % 3, i) for i, (a, b) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, ["features", "label", "fold", "key"]).repartition(5)


def newton(x, y, c):
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([1 / c] * (x.shape[1] - 1) + [0])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
    return w


def test_all_fits_of_one_scan_equal_fits_alone(table):
    x, y, data = table
    points = [(c, f) for c in (0.001, 1.0, 100.0) for f in (None, 0, 1, 2)]
    found = blocks.numeric_blocks(data, "features", "label", ["fold"])
    fits = logistic.fit_many(found, [c for c, _ in points], [f for _, f in points], 3, tol=1e-8)
    for (c, f), w in zip(points, fits.weights):
        rows = np.ones(len(y), bool) if f is None else np.arange(len(y)) % 3 != f
        assert np.allclose(w, newton(x[rows], y[rows], c), atol=1e-5), (c, f)
    assert fits.scans <= 15 and fits.residuals.max() <= 1e-8
    f1 = logistic.held_out_f1(found, fits.weights[1:4], [0, 1, 2])
    for k in range(3):
        rows = np.arange(len(y)) % 3 == k
        said, truth = np.hstack([x[rows], np.ones((rows.sum(), 1))]) @ fits.weights[1 + k] > 0, y[rows] > 0
        assert f1[k] == pytest.approx(2 * (said & truth).sum() / (said.sum() + truth.sum()))
    found.unpersist()


def test_sums_over_many_tasks_are_added_in_groups(table, monkeypatch):
    found = blocks.numeric_blocks(table[2].repartition(9), "features", "label", ["fold"])

    def add(total, block):
        total += [len(block["y"]), block["y"].sum()]

    monkeypatch.setattr(blocks, "DIRECT", 4)
    assert blocks.block_sums(found, 2, add).tolist() == [900, table[1].sum()]
    found.unpersist()


def test_search_tells_scans_and_residual(table):
    found = tune.tune("logistic_regression", table[2], "grid_search")
    assert len(found.scores) == 6 and found.scans <= 15 and found.residual <= 1e-4
    assert found.best_score == max(s for _, s in found.scores) and found.best_model.coefficients.size == 3
    with pytest.raises(ValueError):
        tune.tune("logistic_regression", table[2], "grid_search", grid=[{"nothing": 1}])
    with pytest.raises(ValueError):
        tune.tune("logistic_regression", table[2].where("key < 0"), "grid_search")


def test_a_fold_with_one_class_and_separable_rows(spark):
    rows = [(Vectors.dense([float(i)]), float(i > 5), int(i > 5), i) for i in range(12)]
    data = spark.createDataFrame(rows, ["features", "label", "fold", "key"])
    found = tune.tune("logistic_regression", data, "grid_search", n_folds=2, grid=[{"C": 1.0, "max_iter": 30}])
    assert found.scores[0][1] == 0.0  # each fold holds the class that its fit has not seen
