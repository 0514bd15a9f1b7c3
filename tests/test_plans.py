import json
import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tablewright.operators import models
from tablewright.plans.automl import AutoMLConfig, risk_run, run_automl, save_report
from tablewright.plans.cleaner import Cleaner, CleanerModel
from tablewright.plans.prepare import ROW_KEY, prepare
from tablewright.plans.risk import GOLDEN, risk_automl, risk_cleaner, risk_prepare, risk_transformer
from tablewright.plans.transformer import Transformer, TransformerModel
from tablewright.plans.views import view
from tablewright.session import materialise, release
from tablewright.sources import load_table, write_table
from tablewright.streaming import apply_row_wise


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def people(spark):
    return spark.createDataFrame(
        [(1, " Male", "31", -2.0), (2, "femal", "200 y", 3.0), (3, "none", None, None), (4, "MALE ", "9", 1.0)],
        "ID int, GENDER string, AGE string, X double")


CLEAN = {"golden_specs": {"GENDER": ["male", "female"], "AGE": GOLDEN["AGE"]}, "cols_to_drop": ["ID", "absent"]}


def test_cleaner_steps_and_raw_modes(spark):
    out = Cleaner(**CLEAN).fit_transform(people(spark))
    # The mode of the raw column is raw text, and so is what fills the gaps.
    want = [(" Male", "200 y", 1.0), ("female", "65+", 3.0), ("male", "26-39", 2.0), ("male", "200 y", 1.0)]
    assert rows(out) == sorted(want, key=str)


def test_cleaner_fitted_on_cleaned_rows(spark):
    out = Cleaner(fit_on="cleaned", **CLEAN).fit_transform(people(spark))
    assert {r["GENDER"] for r in out.collect()} == {"male", "female"}
    assert {r["AGE"] for r in out.collect()} == {"65+", "26-39"}


def test_protect_golden(spark):
    df = spark.createDataFrame([("none",), ("university",), ("university",)], "EDUCATION string")
    spec = {"golden_specs": {"EDUCATION": GOLDEN["EDUCATION"]}}
    assert {r[0] for r in Cleaner(**spec).fit_transform(df).collect()} == {"university"}
    kept = Cleaner(protect_golden=True, **spec).fit_transform(df)
    assert {r[0] for r in kept.collect()} == {"none", "university"}


def test_cleaner_errors(spark):
    with pytest.raises(ValueError):
        Cleaner(imputation_strategy="mean")
    with pytest.raises(ValueError):
        Cleaner(golden_specs={}).fit_transform(people(spark)).count()


def test_cleaner_carries_the_key_and_orders_by_it(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (2, 2, None), (3, 3, 7.0), (4, 4, None), (5, 4, None)],
                               "k int, y int, x double")
    out = Cleaner(row_key="k", imputation_strategy="ffill", order_by=["k"]).fit_transform(df)
    # Row 5 equals row 4 but for the key and is gone; the fill follows the key.
    assert rows(out) == [(1, 1, 5.0), (2, 2, 5.0), (3, 3, 7.0), (4, 4, 7.0)]


def test_models_survive_json(spark, sf_dir):
    df = view(spark, sf_dir, "risk")
    cleaner = Cleaner(risk_cleaner()).fit(df)
    again = CleanerModel.from_dict(json.loads(json.dumps(cleaner.to_dict())))
    clean = materialise(cleaner.transform(df))
    assert rows(again.transform(df)) == rows(clean)
    transformer = Transformer(risk_transformer(binning_cols=["ANNUAL_MILEAGE"])).fit(clean)
    twin = TransformerModel.from_dict(json.loads(json.dumps(transformer.to_dict())))
    assert rows(twin.transform(clean)) == rows(transformer.transform(clean))
    release(clean)


def test_transform_is_a_projection(spark, sf_dir):
    done = prepare(view(spark, sf_dir, "risk"), risk_prepare(keep_key=True))
    clean = view(spark, sf_dir, "risk").select("CREDIT_SCORE", "AGE", "TYPE_OF_VEHICLE")
    plan = done.transformer.transform(clean)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_prepare_shapes(spark, sf_dir):
    raw = view(spark, sf_dir, "risk")
    done = prepare(raw, risk_prepare())
    n = raw.count()
    assert len(raw.columns) == 18 == len(done.train.columns) == len(done.test.columns)
    assert done.test.count() == math.ceil(n * 0.2) and done.train.count() == n - math.ceil(n * 0.2)
    share = [df.agg(F.avg("OUTCOME")).first()[0] for df in (done.train, done.test)]
    assert share[0] == pytest.approx(share[1], abs=0.005)
    numbers = [c for c in done.train.columns if c != "OUTCOME"]
    for low, high in zip(done.train.agg(*[F.min(f"`{c}`") for c in numbers]).first(),
                         done.train.agg(*[F.max(f"`{c}`") for c in numbers]).first()):
        assert 0 <= low and high <= 1 + 1e-12


def test_prepare_split_first_and_without_key(spark, sf_dir):
    raw = view(spark, sf_dir, "risk")
    done = prepare(raw, risk_prepare(split_first=True, key=None, test_size=0.25, keep_key=True))
    assert done.train.count() + done.test.count() == raw.count()
    assert done.train.join(done.test, ROW_KEY).count() == 0


def test_prepare_with_ordered_fill(spark, sf_dir):
    done = prepare(view(spark, sf_dir, "risk"), risk_prepare(
        cleaner=risk_cleaner(imputation_strategy="bfill", order_by=[ROW_KEY])))
    gaps = done.train.agg(*[F.count_if(F.col(f"`{c}`").isNull()) for c in done.train.columns]).first()
    assert set(gaps) == {0}


def test_row_wise_models_apply_to_a_stream(spark, sf_dir, tmp_path):
    raw = view(spark, sf_dir, "risk")
    done = prepare(raw, risk_prepare())
    source = write_table(raw.withColumn("FAMILY_STABILITY", F.lit(1.0)), str(tmp_path / "in.parquet"))
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    query = (apply_row_wise(stream, done.cleaner, done.transformer).writeStream.format("memory")
             .queryName("rows_out").start())
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    batch = apply_row_wise(spark.read.parquet(source), done.cleaner, done.transformer)
    assert rows(spark.table("rows_out")) == rows(batch)


def test_stages_compose_in_an_ml_pipeline(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from tablewright.plans.risk import FAMILY
    from tablewright.plans.stages import RowSum, Stage

    raw = view(spark, sf_dir, "risk")
    inputs = ["AGE", "VEHICLE_YEAR", "FAMILY_STABILITY", "TYPE_OF_VEHICLE_suv"]
    chain = Pipeline(stages=[
        Stage(Cleaner(risk_cleaner())), RowSum(FAMILY, "FAMILY_STABILITY"), Stage(Transformer(risk_transformer())),
        VectorAssembler(inputCols=inputs, outputCol="features"),
        models.build_model("decision_tree", 1, label_col="OUTCOME", max_depth=3)])
    fitted = chain.fit(raw)
    assert fitted.stages[2].fitted.scalers and fitted.transform(raw).filter("prediction IS NULL").count() == 0


SMALL = {"logistic_regression": [{"C": 1}], "decision_tree": [{"max_depth": 4}, {"bogus": 1}], "knn": [{"n_neighbors": 3}]}


def test_automl_isolates_failures_and_reports(spark, sf_dir, tmp_path):
    done = prepare(view(spark, sf_dir, "risk"), risk_prepare(keep_key=True))
    config = risk_automl(tuning_method="grid_search", n_features=16, grids=SMALL, save_dir=str(tmp_path / "models"),
                         models=["logistic_regression", "decision_tree", "knn", "nonsense"],
                         base_model=models.build_model("decision_tree", 1, max_depth=4))
    result = run_automl(done.train, done.test, config)
    assert len(result.selected) == 16
    assert result.status["logistic_regression"] == "ok" and "bogus" in result.status["decision_tree"]
    assert "nonsense" in result.status["nonsense"]
    board = result.leaderboard.collect()
    assert {r["model"] for r in board} == {"logistic_regression", "decision_tree", "knn"}
    assert [r["mean_f1_score"] for r in board] == sorted([r["mean_f1_score"] for r in board], reverse=True)
    assert result.champion.first()["model"] == board[0]["model"]
    path = save_report(result, str(tmp_path / "board.json"))
    assert load_table(spark, path, lines=True).filter("champion").first()["model"] == board[0]["model"]
    assert models.load_model(spark, str(tmp_path / "models"), "logistic_regression") is not None


def test_automl_with_nothing_to_report(spark, sf_dir, tmp_path):
    done = prepare(view(spark, sf_dir, "risk"), risk_prepare(keep_key=True))
    result = run_automl(done.train, done.test, risk_automl(models=["nonsense"], n_features=99))
    assert result.leaderboard is None and save_report(result, str(tmp_path / "none.json")) is None
    with pytest.raises(ValueError):
        run_automl(done.train, done.test.drop("OUTCOME"), AutoMLConfig())
    with pytest.raises(ValueError):
        run_automl(done.train.drop(ROW_KEY), done.test, AutoMLConfig())


def test_risk_run_from_file(spark, sf_dir, tmp_path):
    source = write_table(view(spark, sf_dir, "risk"), str(tmp_path / "risk.csv"), "csv")
    config = risk_automl(tuning_method="default", models=["logistic_regression"], n_features=17)
    result = risk_run(spark, source, risk_prepare(), config, str(tmp_path / "out"))
    assert result.leaderboard.first()["mean_f1_score"] > 0.5
    assert load_table(spark, str(tmp_path / "out" / "train.parquet")).count() > 0


def test_entry_and_contract(spark):
    assert contract.entry(spark).count() == 1
    assert set(contract.oracle_sql()) <= set(contract.queries())
