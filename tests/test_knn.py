from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import knn
from tablewright.operators.knn import KNNClassifier, KNNModel, vote, vote_many
from tablewright.session import scratch_scope


def tables(spark, train, test, labels):
    to_df = lambda x, y: spark.createDataFrame(
        [(i, [float(v) for v in row], int(c)) for i, (row, c) in enumerate(zip(x, y))],
        "id long, features array<double>, label int").repartition(4)
    return to_df(train, labels), to_df(test, [0] * len(test))


def brute(train, test, k, p):
    d = np.abs(test[:, None, :] - train[None, :, :])
    d = np.round(d.sum(axis=2) if p == 1 else np.sqrt((d * d).sum(axis=2)), 9)
    return [[int(j) for j in np.lexsort((np.arange(len(train)), row))[:k]] for row in d]


def found(model, test, k=None):
    out = {}
    for r in model.neighbours(test, k).orderBy("test_key", "rank").collect():
        out.setdefault(r["test_key"], []).append(r["train_key"])
    return [out[i] for i in sorted(out)]


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("shape", ["clusters", "one_hot_cell", "high_dimension", "equal_points"])
def test_pruned_search_equals_brute_force(spark, p, shape):
    """Many cells, tiny blocks: every path of the search runs and no neighbour is lost."""
    rng = np.random.default_rng(4)
    n, m, k = 300, 60, 5
    if shape == "clusters":
        centres = rng.normal(0, 20, (8, 3))
        train, test = (centres[rng.integers(0, 8, c)] + rng.normal(0, 1, (c, 3)) for c in (n, m))
    elif shape == "one_hot_cell":
        # Two thirds of all rows sit in one spot.
        train = np.concatenate([rng.normal(0, 0.01, (200, 2)), rng.normal(0, 30, (100, 2))])
        test = np.concatenate([rng.normal(0, 0.01, (40, 2)), rng.normal(0, 30, (20, 2))])
    elif shape == "high_dimension":
        train, test = rng.random((n, 24)), rng.random((m, 24))
    else:
        train, test = rng.integers(0, 3, (n, 2)).astype(float), rng.integers(0, 3, (m, 2)).astype(float)
    train_df, test_df = tables(spark, train, test, rng.integers(0, 2, n))
    model = KNNClassifier(k, p=p, key_col="id", block_rows=32, rows_per_pivot=30).fit(train_df)
    assert found(model, test_df) == brute(train, test, k, p)


def test_more_neighbours_than_any_cell_holds(spark):
    rng = np.random.default_rng(9)
    train, test = rng.random((60, 2)), rng.random((10, 2))
    train_df, test_df = tables(spark, train, test, [0] * 60)
    model = KNNClassifier(50, key_col="id", block_rows=8, rows_per_pivot=4).fit(train_df)
    assert found(model, test_df) == brute(train, test, 50, 2)


def test_votes(spark):
    near = spark.createDataFrame(
        [(1, 1, 1.0, 1.0), (1, 2, 0.0, 1.5), (1, 3, 0.0, 1.5), (1, 4, 1.0, 9.0),
         (2, 1, 0.0, 0.0), (2, 2, 1.0, 0.1), (2, 3, 1.0, 0.1), (2, 4, 1.0, 0.1)],
        "test_key int, rank int, label double, distance double")

    def predictions(k, weights):
        return {r["test_key"]: r["prediction"] for r in vote(near, k, weights).collect()}

    assert predictions(3, "uniform") == {1: 0.0, 2: 1.0}
    assert predictions(4, "uniform") == {1: 0.0, 2: 1.0}          # row 1 is a tie: smaller label
    assert predictions(3, "distance") == {1: 0.0, 2: 0.0}         # row 2 touches a training row
    assert predictions(2, "distance") == {1: 1.0, 2: 0.0}


def test_transform_save_load(spark, tmp_path):
    rng = np.random.default_rng(1)
    train, test = rng.random((80, 3)), rng.random((20, 3))
    train_df, test_df = tables(spark, train, test, (train[:, 0] > 0.5).astype(int))
    model = KNNClassifier(3, key_col="id").fit(train_df)
    model.save(str(tmp_path / "knn"))
    again = KNNModel.load(str(tmp_path / "knn"))
    pick = lambda m: sorted((r["id"], r["prediction"], float(r["probability"][1])) for r in m.transform(test_df).collect())
    assert pick(model) == pick(again) and len(pick(model)) == 20
    accuracy = model.transform(test_df).filter(F.col("prediction") == (F.col("features")[0] > 0.5).cast("double")).count()
    assert accuracy >= 16


def test_bad_settings(spark):
    for settings in ({"weights": "rank"}, {"p": 3}, {"k": 0}, {"key_col": None}):
        with pytest.raises(ValueError):
            KNNClassifier(**{"key_col": "id", **settings})
    train_df, test_df = tables(spark, np.zeros((2, 1)), np.zeros((1, 1)), [0, 1])
    with pytest.raises(ValueError):
        KNNClassifier(5, key_col="id").fit(train_df).neighbours(test_df)


@pytest.mark.parametrize("p", [1, 2])
def test_small_cells_do_not_multiply_what_is_shipped(spark, p):
    """Cells of 20 rows in many dimensions, where no box excludes anything: the visits stay few, whatever cells are asked for."""
    rng = np.random.default_rng(11)
    train, test = rng.normal(size=(3000, 48)), rng.normal(size=(600, 48))
    train_df, test_df = tables(spark, train, test, [0] * 3000)
    model = KNNClassifier(5, p=p, key_col="id", rows_per_pivot=20, block_rows=16).fit(train_df)
    with scratch_scope(spark) as scope:
        assert found(model, test_df) == brute(train, test, 5, p)
        folder = Path(next(path for path in scope.paths if "knn-visits" in path).removeprefix("file:"))
        assert sum(f.stat().st_size for f in folder.glob("*.parquet")) < 10e6  # 600 rows that visit each of 150 cells are 35 MB


@pytest.mark.parametrize("p", [1, 2])
def test_blocks_of_large_cells_and_equal_rows(spark, p, monkeypatch):
    """Cells of several blocks, more equal rows than neighbours, and missing numbers, which are never near."""
    monkeypatch.setattr(knn, "CELL_BYTES", 1200)
    rng = np.random.default_rng(12)
    train = np.concatenate([np.tile([0.5, 0.5, 0.5], (300, 1)), rng.integers(0, 4, (300, 3)), [[0.5, np.nan, 0.5]]])
    test = np.concatenate([np.tile([0.5, 0.5, 0.5], (20, 1)), rng.integers(0, 4, (30, 3)).astype(float)])
    train_df, test_df = tables(spark, train, test, [0] * len(train))
    model = KNNClassifier(7, p=p, key_col="id", rows_per_pivot=60, block_rows=8).fit(train_df)
    assert found(model, test_df) == brute(train, test, 7, p)


def test_votes_side_by_side(spark):
    rng = np.random.default_rng(13)
    rows = [(t, r, float(rng.integers(0, 3)), float(d)) for t in range(40) for r, d in enumerate(np.sort(rng.integers(0, 6, 9)), 1)]
    near = spark.createDataFrame([(t, r, r, *rest) for t, r, *rest in rows], "test_key int, rank int, train_key int, label double, distance double")
    points = [(i, k, w) for i, (k, w) in enumerate((k, w) for k in (1, 4, 9) for w in ("uniform", "distance"))]
    together = {(r["point"], r["test_key"]): (r["prediction"], r["score"]) for r in vote_many(near, points).collect()}
    for i, k, w in points:
        assert {key: v for (point, key), v in together.items() if point == i} == {r["test_key"]: (r["prediction"], r["score"]) for r in vote(near, k, w).collect()}
        for t in range(40):
            mine = [(c, d) for key, r, c, d in rows if key == t and r <= k]
            zero = any(d == 0 for _, d in mine)
            shares = {c: round(sum((1.0 if w == "uniform" else float(d == 0) if zero else 1 / d) for x, d in mine if x == c), 9) for c, _ in mine}
            assert together[i, t][0] == min(shares, key=lambda c: (-shares[c], c))
