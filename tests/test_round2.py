"""Lossless text files, any number of classes, the squared hinge, repair by distinct values, saved stages, deleted tables."""

import datetime
import os

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tablewright.functions import fuzzy
from tablewright.functions.fuzzy import canonicalise_columns, weighted_score
from tablewright.operators import metrics, models, split, stats, svm, transforms
from tablewright.operators.knn import KNNClassifier
from tablewright.operators.ordered import fill_along, row_numbers
from tablewright.operators.select import assemble
from tablewright.operators.tune import tune
from tablewright.plans.cleaner import Cleaner
from tablewright.plans.prepare import ROW_KEY, prepare
from tablewright.plans.risk import TARGET, risk_prepare
from tablewright.plans.stages import RowSum, Stage
from tablewright.plans.transformer import Transformer
from tablewright.plans.views import view
from tablewright.session import scratch_dir, scratch_scope
from tablewright.sources import load_table, write_table


def tables_in_scratch(spark):
    folder = f"{scratch_dir(spark)}/tablewright"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


# --- text files -----------------------------------------------------------------------------------------

def test_csv_keeps_every_text(spark, tmp_path):
    texts = ["  lead", "tail  ", "a\nb", "a\rb", "a\r\nb", 'say "x"', '"', "a,b", "\\", "\\n", "a\\", " ", "\t", "#c", "é漢🙂", None, "\n", "x,\"\n"]
    rows = list(enumerate(texts))
    path = write_table(spark.createDataFrame(rows, "i bigint, t string"), str(tmp_path / "t.csv"), "csv", rows_per_file=3)
    assert sorted(map(tuple, load_table(spark, path).collect())) == rows
    files = [f for f in os.listdir(path) if f.startswith("part")]
    assert len(files) >= 6


def test_csv_times_by_schema(spark, tmp_path):
    rows = [(1, datetime.datetime(2024, 1, 2, 3, 4, 5, 678901)), (2, None)]
    df = spark.createDataFrame(rows, "i int, ts timestamp_ntz")
    path = write_table(df, str(tmp_path / "t.csv"), "csv")
    assert sorted(map(tuple, load_table(spark, path, schema=df.schema).collect())) == rows


def test_inference_makes_no_row_per_cell(spark, tmp_path):
    path = write_table(spark.range(50).selectExpr("id", "id / 2 AS half", "'x' AS t"), str(tmp_path / "t.csv"), "csv")
    df = load_table(spark, path)
    assert dict(df.dtypes) == {"id": "bigint", "half": "double", "t": "string"} and df.count() == 50


# --- caps -----------------------------------------------------------------------------------------------

def test_depths_are_honoured_or_refused():
    assert models.build_model("random_forest", 1, max_depth=20).getMaxDepth() == 20
    assert models.build_model("random_forest", 1, max_depth=None, unlimited_depth=12).getMaxDepth() == 12
    for name in ("decision_tree", "random_forest", "xgboost"):
        with pytest.raises(ValueError, match="limit"):
            models.build_model(name, 1, max_depth=31)


def test_many_classes(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("c"), F.col("id") % 400)).alias("c"))
    marked = split.mark_folds(split.mark_holdout(df, ["id"], 0.2, "c"), ["id"], 3, stratify_by="c").toPandas()
    assert len(marked) == 3000 and marked["is_test"].sum() == 600
    sizes = marked.groupby("c", dropna=False)["is_test"].agg(["sum", "count"])
    assert ((sizes["sum"] - 0.2 * sizes["count"]).abs() < 1).all()
    folds = marked.groupby(["c", "fold"], dropna=False).size().unstack(fill_value=0)
    assert (folds.max(axis=1) - folds.min(axis=1)).max() <= 1
    again = split.mark_holdout(df.repartition(5), ["id"], 0.2, "c").toPandas()
    assert set(again.loc[again.is_test, "id"]) == set(marked.loc[marked.is_test, "id"])


def test_many_classes_refuse_a_key_that_repeats(spark):
    df = spark.range(600).select((F.col("id") % 100).alias("c"), F.lit(1).alias("k"))
    with pytest.raises(ValueError, match="unique"):
        split.mark_holdout(df, ["k"], 0.5, "c").count()


def test_row_numbers(spark):
    got = row_numbers(spark.range(1000).repartition(7), [F.col("id").desc()], "n").collect()
    assert all(r["id"] + r["n"] == 999 for r in got)


def test_categories_have_no_limit_but_the_given_one(spark):
    df = spark.range(12000).select(F.col("id").cast("string").alias("t"), F.lit("x").alias("u"))
    assert len(stats.fit_categories(df, ["t"])["t"]) == 12000
    with pytest.raises(ValueError, match="'t'"):
        stats.fit_categories(df, ["t", "u"], limit=100)


def test_power_search_reports_failure(spark):
    with pytest.raises(ValueError, match="finite"):
        transforms.fit_yeo_johnson(spark.createDataFrame([(3.0,), (3.0,)], "x double"), {"x": F.col("x")})


# --- squared hinge --------------------------------------------------------------------------------------

@pytest.mark.parametrize("penalty", ["l1", "l2"])
@pytest.mark.parametrize("c", [0.01, 1.0, 100.0])
def test_squared_hinge_is_optimal(spark, tmp_path, penalty, c):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (300, 4))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(0, 0.5, 300) > 0.2).astype(float)
    df = assemble(spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, d double, label double"),
                  ["a", "b", "c", "d"], "label")
    model = models.build_model("svm", 300, C=c, penalty=penalty, tol=1e-8).fit(df)
    weights = np.append(model.coefficients.toArray(), model.intercept)
    full, signs = np.hstack([x, np.ones((300, 1))]), 2 * y - 1

    def worth(w):
        loss = c * (np.maximum(0, 1 - signs * (full @ w)) ** 2).sum()
        return loss + (0.5 * w @ w if penalty == "l2" else np.abs(w).sum())

    best = worth(weights)
    assert all(best <= worth(weights + step) + 1e-9 for step in rng.normal(0, 1e-3, (200, 5)))
    if penalty == "l1" and c == 0.01:
        assert (weights == 0).any()
    scored = model.transform(df).select("prediction", metrics.score_column(model.transform(df)).alias("s")).collect()
    assert np.allclose(sorted(r["s"] for r in scored), sorted(full @ weights)) and all((r["s"] > 0) == (r["prediction"] == 1) for r in scored)
    models.save_model(model, str(tmp_path), "knn_like_name")
    again = models.load_model(spark, str(tmp_path), "knn_like_name")
    assert np.allclose(again.coefficients.toArray(), weights[:-1]) and again.intercept == pytest.approx(weights[-1])


# --- repair by distinct values --------------------------------------------------------------------------

CASES = [("school high", "high school"), ("the high school", "high school"), ("universty", "university"), ("uni", "university"),
         ("none", "none"), (None, None), ("zzz", None), ("hgh shcool", None), ("university of somewhere far away and further", "university")]


@pytest.mark.parametrize("literal, small", [(1000, 20_000), (0, 20_000), (0, 0)])
def test_repair_scores_distinct_values_once(spark, monkeypatch, literal, small):
    monkeypatch.setattr(fuzzy, "LITERAL_VALUES", literal)
    monkeypatch.setattr(fuzzy, "BROADCAST_VALUES", small)
    golden = ["none", "high school", "university"]
    rows = [(i, v, "x", want) for i, (v, want) in enumerate(CASES * 30)]
    df = spark.createDataFrame(rows, "i int, a string, b string, want string").repartition(4)
    out = canonicalise_columns(df, {"a": golden, "b": ["x", "y"]})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and ("Join" not in plan) == bool(literal)
    got = out.collect()
    assert len(got) == len(rows) and all(r["a"] == r["want"] and r["b"] == "x" for r in got)


def test_ties_and_lengths():
    assert weighted_score("a b", "b a") == 95 and weighted_score("ab", "abcdefghijklmnopqrst") == 60
    assert weighted_score("high school", "high  school!") == 100


# --- stages ---------------------------------------------------------------------------------------------

def test_pipeline_is_saved_fitted_and_unfitted(spark, sf_dir, tmp_path):
    raw, config = view(spark, sf_dir, "risk"), risk_prepare()
    stages = [Stage(Cleaner(config.cleaner)), RowSum(["MARRIED", "CHILDREN", "VEHICLE_OWNERSHIP"], "FAMILY_STABILITY"), Stage(Transformer(config.transformer))]
    fitted = Pipeline(stages=stages).fit(raw)
    Pipeline(stages=stages).save(str(tmp_path / "plan"))
    fitted.save(str(tmp_path / "fitted"))
    want = sorted(map(str, fitted.transform(raw).collect()))
    assert sorted(map(str, PipelineModel.load(str(tmp_path / "fitted")).transform(raw).collect())) == want
    assert sorted(map(str, Pipeline.load(str(tmp_path / "plan")).fit(raw).transform(raw).collect())) == want


def test_knn_is_saved_before_and_after_fitting(spark, tmp_path):
    df = assemble(spark.range(60).selectExpr("id", "id % 7 AS x", "id % 2 AS label"), ["x"], "label", ["id"])
    KNNClassifier(3, "distance", 1, key_col="id").save(str(tmp_path / "plan"))
    model = KNNClassifier.load(str(tmp_path / "plan")).fit(df)
    model.save(str(tmp_path / "model"))
    again = type(model).load(str(tmp_path / "model"))
    assert again.settings == model.settings and again.settings["weights"] == "distance"
    assert sorted(map(str, again.transform(df).collect())) == sorted(map(str, model.transform(df).collect()))


# --- intermediate tables --------------------------------------------------------------------------------

def test_scratch_is_empty_after_release(spark, sf_dir):
    before = tables_in_scratch(spark)
    with scratch_scope(spark):
        assert metrics.auc(view(spark, sf_dir, "scored")).first() is not None
        gappy = view(spark, sf_dir, "gappy_events").select("event_id", "value")
        assert fill_along(gappy, ["event_id"]).count() == gappy.count()
        assert tables_in_scratch(spark) - before
    assert tables_in_scratch(spark) == before
    for split_first in (False, True):
        done = prepare(view(spark, sf_dir, "risk"), risk_prepare(keep_key=True, split_first=split_first))
        if not split_first:
            data = assemble(split.mark_folds(done.train, [ROW_KEY], 3), ["AGE", "VEHICLE_YEAR"], TARGET, [ROW_KEY, "fold"])
            found = tune("knn", data, "grid_search", grid=[{"n_neighbors": 3}, {"n_neighbors": 5, "p": 1}], key_col=ROW_KEY)
            found.best_model.release()
        done.release()
        assert tables_in_scratch(spark) == before


def test_text_source_is_parsed_once_after_inference(spark, sf_dir, tmp_path):
    path = write_table(view(spark, sf_dir, "risk"), str(tmp_path / "raw.csv"), "csv")
    done = prepare(load_table(spark, path), risk_prepare(keep_key=True))
    assert not any(f.endswith(".csv") for f in done.train.inputFiles())
    done.release()
