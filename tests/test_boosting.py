import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from tablewright.operators import boosting, models


def make(spark, x, y, parts=5):
    return spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]).repartition(parts)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(1500, 4)), 1)  # few values: a bin each
    x[rng.random(x.shape) < 0.1] = np.nan
    logit = np.where(np.isnan(x[:, 0]), 1.5, 1.2 * x[:, 0]) + np.where(np.nan_to_num(x[:, 1]) > 0.4, 1.0, -1.0)
    return x, (rng.random(1500) < 1 / (1 + np.exp(-logit))).astype(float)


def brute_tree(x, g, h, depth, lam, gamma, least, cuts):
    """The best tree level by level, by trying every cut and side; returns the value of each row and the leaves' (rows, weight)."""
    out = np.zeros(len(g))

    def node(rows, at):
        G, H = g[rows].sum(), h[rows].sum()
        best = (1e-12, None)
        if at < depth:
            for j in range(x.shape[1]):
                for cut in cuts[j]:
                    for missing_left in (True, False):
                        left = np.where(np.isnan(x[rows, j]), missing_left, x[rows, j] <= cut)
                        a, b = rows[left], rows[~left]
                        if h[a].sum() < least or h[b].sum() < least:
                            continue
                        gain = (g[a].sum() ** 2 / (h[a].sum() + lam) + g[b].sum() ** 2 / (h[b].sum() + lam) - G ** 2 / (H + lam)) / 2 - gamma
                        if gain > best[0] + 1e-9:
                            best = (gain, (a, b))
        if best[1] is None:
            out[rows] = -G / (H + lam)
            return
        for part in best[1]:
            node(part, at + 1)

    node(np.arange(len(g)), 0)
    return out


def test_trees_equal_brute_force(spark, data, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    x, y = data
    model = boosting.SecondOrderBoosting(maxIter=5, stepSize=0.5, maxDepth=3, maxBins=200, regLambda=2.0, gamma=0.3, minChildWeight=3.0).fit(make(spark, x, y))
    values = [np.unique(c[~np.isnan(c)])[:-1] for c in x.T]
    margin = np.zeros(len(y))
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        want = 0.5 * brute_tree(x, p - y, p * (1 - p), 3, 2.0, 0.3, 3.0, values)
        assert np.allclose(tree.of(x, False), want, atol=1e-9)
        margin += want
    got = {tuple(r["features"].toArray().tolist() + [r["label"]]): r["probability"][1] for r in model.transform(make(spark, x, y)).collect()}
    for row, label, m in zip(x, y, margin):
        if not np.isnan(row).any():
            assert got[tuple([*row.tolist(), label])] == pytest.approx(1 / (1 + np.exp(-m)))
    assert model.featureImportances.toArray().sum() == pytest.approx(1) and np.argmax(model.featureImportances.toArray()) in (0, 1)


def test_columns_are_drawn_per_tree_and_rows_again_alike(spark, data):
    x, y = data
    of = lambda parts: boosting.SecondOrderBoosting(maxIter=6, maxDepth=4, columnsPerTree=0.5, subsamplingRate=0.7, seed=3).fit(make(spark, x, y, parts))
    one, two = of(4), of(4)
    assert [t.__dict__ for t in one.trees] == [t.__dict__ for t in two.trees]
    assert all(len({f for f in t.feature if f >= 0}) <= 2 for t in one.trees)
    assert len({f for t in one.trees for f in t.feature if f >= 0}) == 4


def test_sums_of_many_tasks_are_added_in_groups(spark, data, monkeypatch):
    x, y = data
    want = boosting.SecondOrderBoosting(maxIter=2, maxDepth=3).fit(make(spark, x, y, 3)).trees
    monkeypatch.setattr(boosting, "DIRECT", 1)
    monkeypatch.setattr(boosting, "TASK_BYTES", 1 << 10)
    got = boosting.SecondOrderBoosting(maxIter=2, maxDepth=3).fit(make(spark, x, y, 7)).trees
    assert [t.feature for t in got] == [t.feature for t in want] and np.allclose(got[1].value, want[1].value)


def test_edges(spark, tmp_path):
    const = make(spark, np.ones((20, 2)), np.arange(20) % 4 == 0)
    model = boosting.SecondOrderBoosting(maxIter=3, stepSize=1.0, regLambda=0.0, minChildWeight=0.0).fit(const)
    assert all(t.feature == [-1] for t in model.trees)
    assert model.transform(const).first()["probability"][1] == pytest.approx(0.25, abs=1e-3)
    all_missing = make(spark, np.full((8, 2), np.nan), np.ones(8))
    assert boosting.SecondOrderBoosting(maxIter=2).fit(all_missing).transform(all_missing).first()["prediction"] == 1.0
    with pytest.raises(ValueError):
        boosting.SecondOrderBoosting().fit(const.limit(0))
    with pytest.raises(ValueError):
        boosting.SecondOrderBoosting(maxBins=300).fit(const)
    saved = models.save_model(model, str(tmp_path), "boosting")
    again = PipelineModel.load(saved)
    assert again.transform(const).first()["probability"] == model.transform(const).first()["probability"]
