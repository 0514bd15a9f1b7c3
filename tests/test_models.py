import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tablewright.operators import models, tune
from tablewright.operators.metrics import mean_metrics, score_column
from tablewright.operators.select import assemble, select_features
from tablewright.operators.split import mark_folds

FEATURES = ["good", "noise", "weak", "flat"]


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        y = int(rng.random() < 0.5)
        rows.append((i, float(y + rng.normal(0, 0.3)), float(rng.normal()), float(y + rng.normal(0, 1.5)), 1.0, y))
    df = spark.createDataFrame(rows, "id long, good double, noise double, weak double, flat double, y int")
    return df.cache()


@pytest.fixture(scope="module")
def folded(raw):
    return mark_folds(assemble(raw, FEATURES, "y", ["id"]), ["id"], 3).cache()


PARAMS = {"logistic_regression": {}, "svm": {"max_iter": 20}, "decision_tree": {"max_depth": 3},
          "random_forest": {"n_estimators": 5, "max_depth": 3}, "xgboost": {"n_estimators": 3, "max_depth": 2},
          "knn": {"n_neighbors": 3}}


@pytest.mark.parametrize("name", models.SUPPORTED_MODELS)
def test_every_model_learns_predicts_saves_and_loads(spark, folded, tmp_path, name):
    model = models.train_model(models.build_model(name, 600, key_col="id", **PARAMS[name]), folded)
    out = models.predict(model, folded)
    scored = out.select("id", "label", "prediction", score_column(out).alias("score"), F.lit(0).alias("fold"))
    assert mean_metrics(scored).first()["mean_f1_score"] > 0.9
    models.save_model(model, str(tmp_path), name)
    again = models.load_model(spark, str(tmp_path), name)
    pick = lambda m: sorted((r["id"], r["prediction"]) for r in m.transform(folded).collect())
    assert pick(model) == pick(again)


def test_factory_errors():
    with pytest.raises(ValueError):
        models.build_model("naive_bayes", 10)
    with pytest.raises(ValueError):
        models.build_model("svm", 10, gamma=1)
    with pytest.raises(ValueError):
        models.param_grid("naive_bayes")
    with pytest.raises(ValueError):
        models.train_model(None, None)
    with pytest.raises(ValueError):
        models.predict(None, None)
    assert models.save_model(None, "/nowhere", "svm") is None


def test_parameters_translate(spark):
    lr = models.build_model("logistic_regression", 200, C=0.5)
    assert lr.getRegParam() == pytest.approx(1 / (0.5 * 200)) and lr.getMaxIter() == 1000
    tree = models.build_model("decision_tree", 1, max_depth=None, criterion="entropy", min_samples_leaf=4)
    assert [tree.getOrDefault(k) for k in ("maxDepth", "impurity", "minInstancesPerNode", "numTrees", "bootstrap")] == [-1, "entropy", 4, 1, False]
    gbt = models.build_model("xgboost", 1, colsample_bytree=0.8, subsample=0.8, learning_rate=0.05)
    wanted = {"columnsPerTree": 0.8, "subsamplingRate": 0.8, "stepSize": 0.05, "maxIter": 100, "maxDepth": 6, "regLambda": 1.0, "gamma": 0.0}
    assert {k: gbt.getOrDefault(k) for k in wanted} == wanted
    assert tree.getSeed() == 42 and models.build_model("decision_tree", 1, random_state=7).getSeed() == 7


def test_grids_and_draws():
    sizes = {m: len(models.param_grid(m)) for m in models.SUPPORTED_MODELS}
    assert sizes == {"logistic_regression": 6, "svm": 8, "decision_tree": 24, "random_forest": 8, "xgboost": 72,
                     "knn": 20}
    grid = models.param_grid("xgboost")
    drawn = models.draw_from_grid(grid)
    assert len(drawn) == 10 and all(d in grid for d in drawn) and drawn == models.draw_from_grid(grid)
    assert len({str(d) for d in drawn}) == 10
    assert models.draw_from_grid(models.param_grid("svm")) == models.param_grid("svm")


def test_grid_search_picks_the_best_and_refits(folded):
    found = tune.tune("decision_tree", folded, "grid_search",
                      grid=[{"max_depth": 1, "min_samples_leaf": 290}, {"max_depth": 3}])
    assert found.best_params == {"max_depth": 3} and len(found.scores) == 2
    assert found.best_score == max(s for _, s in found.scores)
    assert found.best_model.getMaxDepth() == 3 and found.best_model.numNodes > 1


def test_grid_search_scores_match_a_hand_made_loop(folded):
    found = tune.tune("logistic_regression", folded, "grid_search", grid=[{"C": 0.01}, {"C": 10}])
    for params, score in found.scores:
        total = 0.0
        for fold in range(3):
            train, valid = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
            model = models.build_model("logistic_regression", train.count(), **params).fit(train)  # C weighs the loss of the rows it is fitted on
            total += tune.f1_evaluator().evaluate(model.transform(valid))
        assert score == pytest.approx(total / 3, abs=1e-9)


def test_default_and_failing_search(folded):
    found = tune.tune("logistic_regression", folded, "default")
    assert found.best_params == {} and found.best_score > 0.9
    failed = tune.tune_or_default("decision_tree", folded, method="grid_search", grid=[{"bogus": 1}])
    assert failed.best_params == {} and "bogus" in failed.status and failed.best_model is None
    with pytest.raises(ValueError):
        tune.tune("svm", folded, "bayes")


def test_knn_search_shares_neighbours(folded):
    grid = [{"n_neighbors": k, "weights": w, "p": p} for k in (1, 5) for w in ("uniform", "distance") for p in (1, 2)]
    found = tune.tune("knn", folded, "grid_search", grid=grid, key_col="id")
    assert len(found.scores) == 8 and found.best_score > 0.9
    by = {(c["n_neighbors"], c["weights"], c["p"]): s for c, s in found.scores}
    # One neighbour: the weights cannot matter.
    assert by[(1, "uniform", 2)] == pytest.approx(by[(1, "distance", 2)])


@pytest.mark.parametrize("method", ["rfe", "forward", "backward"])
def test_selection_keeps_the_informative_feature(raw, method):
    base = models.build_model("decision_tree", 1, max_depth=3)
    chosen = select_features(raw, FEATURES, "y", method, 2, base, ["id"])
    assert len(chosen) == 2 and "good" in chosen and chosen == [c for c in FEATURES if c in chosen]


def test_selection_by_coefficients_and_short_cuts(raw):
    base = LogisticRegression(featuresCol="features", labelCol="label")
    assert select_features(raw, FEATURES, "y", "rfe", 1, base) == ["good"]
    assert select_features(raw, FEATURES, "y", "rfe", 9) == FEATURES
    with pytest.raises(ValueError):
        select_features(raw, FEATURES, "y", "lasso", 2)
    with pytest.raises(ValueError):
        select_features(raw, FEATURES, "y", "forward", 2)
