import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import columns as cols
from tablewright.operators import metrics, ranges, stats, transforms
from tablewright.operators.dedup import drop_duplicate_rows
from tablewright.operators.impute import fill_values, fit_fill_values, impute
from tablewright.operators.ordered import fill_along, running_totals
from tablewright.operators.quantiles import exact_medians, exact_quantiles
from tablewright.operators.split import holdout_split, mark_folds, mark_holdout


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- columns, duplicates, ranges ------------------------------------------------------------------------

def test_column_kinds(spark):
    df = spark.sql("SELECT 1 a, 1.5D b, 1.5 c, 'x' d, true e, current_date() f, array(1) g")
    assert cols.numeric_columns(df) == ["a", "b", "c"] and cols.text_columns(df) == ["d"]
    assert cols.numeric_columns(df, ["b"]) == ["a", "c"]


def test_names_with_dots_and_blanks(spark):
    df = spark.createDataFrame([(-1.0, "x")], ["a.b c", "t"])
    assert rows(cols.absolute(df)) == [(1.0, "x")]
    assert cols.absolute(df).columns == ["a.b c", "t"]


def test_split_target(spark):
    df = spark.createDataFrame([(1, 2, 0)], "ID int, x int, OUTCOME int")
    assert cols.split_target(df, "OUTCOME") == (["x"], "OUTCOME")
    with pytest.raises(ValueError):
        cols.split_target(df.drop("OUTCOME"), "OUTCOME")


def test_row_sum_coerces_and_skips(spark):
    df = spark.createDataFrame([("1", 2, None), ("x", None, 3.5)], "a string, b int, c double")
    assert [r["s"] for r in cols.row_sum(df, ["a", "b", "c"], "s").collect()] == [3.0, 3.5]
    assert "s" not in cols.row_sum(df, ["a", "absent"], "s").columns


def test_duplicates_missing_equals_missing(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "a"), (3, 1.0, "a")], "k int, x double, t string")
    assert drop_duplicate_rows(df.drop("k")).count() == 2
    assert rows(drop_duplicate_rows(df, "k")) == [(1, None, "a"), (3, 1.0, "a")]


def test_drop_or_null_policy(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(100)], "i int, x double")
    assert ranges.enforce_ranges(df, {"x": (0, 95)}, 0.05).count() == 96           # 4 % < 5 %: rows go
    kept = ranges.enforce_ranges(df, {"x": (0, 94)}, 0.05)                          # 5 % = 5 %: cells go
    assert kept.count() == 100 and kept.filter("x IS NULL").count() == 5
    assert ranges.enforce_ranges(df, {"x": (0, None)}, 0.05).count() == 100
    assert ranges.enforce_ranges(df, {"absent": (0, 1)}, 0.05) is df
    assert ranges.enforce_ranges(df.limit(0), {"x": (0, 1)}, 0.05).count() == 0


def test_two_rules_count_a_row_once(spark):
    df = spark.createDataFrame([(-1.0, -1.0), *[(1.0, 1.0)] * 30], "x double, y double")
    assert ranges.enforce_ranges(df, {"x": (0, None), "y": (0, None)}, 0.05).count() == 30


# --- quantiles and statistics ---------------------------------------------------------------------------

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["uniform", "heavy", "few", "long_tail", "two_rows", "one_row", "negative"])
def test_exact_quantiles_match_numpy(spark, kind):
    rng = np.random.default_rng(7)
    x = {
        "uniform": rng.random(60_000),
        # A third of the rows share one value in the middle, right next to the wanted ranks.
        "heavy": np.concatenate([rng.random(40_000), np.full(20_000, 0.5)]),
        "few": rng.integers(0, 3, 30_000).astype(float),
        "long_tail": np.exp(rng.normal(0, 4, 50_000)),
        "two_rows": np.array([1.0, 2.0]),
        "one_row": np.array([3.0]),
        "negative": -rng.random(20_000) * 1e12,
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(8)
    got = exact_quantiles(df, {"x": PROBS})["x"]
    assert got == pytest.approx(list(np.quantile(x, PROBS)), rel=1e-12, abs=1e-15)


def test_quantile_search_narrows_in_several_passes(spark, monkeypatch):
    """With a coarse sketch the search needs many passes and the wrong turns they take."""
    from tablewright.operators import quantiles

    monkeypatch.setattr(quantiles, "ACCURACY", 40)
    monkeypatch.setattr(quantiles, "GRID", 20)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=20_000), np.full(10_000, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(4)
    assert quantiles.exact_quantiles(df, {"x": PROBS})["x"] == pytest.approx(list(np.quantile(x, PROBS)), rel=1e-12)


def test_quantiles_skip_missing_and_nan(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, None)], "x double, e double")
    assert exact_medians(df, ["x", "e"]) == {"x": 2.0, "e": None}


def test_modes_ties_and_all_missing(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "t string, e string")
    assert stats.fit_modes(df, ["t", "e"]) == {"t": "a", "e": "Unknown"}
    assert stats.fit_modes(df, []) == {}


def test_population_skewness_and_std(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "x double")
    m = stats.fit_moments(df, ["x"])["x"]
    x = np.array([1, 2, 3, 4, 100.0])
    assert m["std"] == pytest.approx(x.std())
    assert m["skew"] == pytest.approx(((x - x.mean()) ** 3).mean() / x.std() ** 3)
    assert m["count"] == 5 and m["missing"] == 0


def test_bin_edges_merge_equal_quantiles(spark):
    df = spark.createDataFrame([(0.0,)] * 70 + [(float(i),) for i in range(1, 31)], "x double")
    edges = stats.fit_bin_edges(df, ["x"])["x"]
    assert edges[0] == 0.0 and edges == sorted(set(edges)) and len(edges) == 3


def test_category_limit(spark):
    df = spark.createDataFrame([(str(i),) for i in range(20)], "t string")
    assert len(stats.fit_categories(df, ["t"])["t"]) == 20
    with pytest.raises(ValueError):
        stats.fit_categories(df, ["t"], limit=10)


def test_audit(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 5.0), (3, 5.0), (4, None)], "k int, x double")
    got = {(r["step"], r["column"]): r["n"] for r in
           stats.audit(df, {"x": (0, 4)}, ["x"], {"x": (0.0, 9.0)}, drop=["k"]).collect()}
    assert got == {("rows", None): 4, ("distinct_rows", None): 3, ("negative", "x"): 1, ("violation", "x"): 2,
                   ("bad_rows", None): 2, ("capped", "x"): 1}


# --- imputation and ordered fills -----------------------------------------------------------------------

def test_impute_auto_types(spark):
    df = spark.createDataFrame([(1, 1, None), (None, 2, "x"), (3, None, "x")], "a int, b int, t string")
    out = impute(df, *fit_fill_values(df))
    assert dict(out.dtypes) == {"a": "int", "b": "double", "t": "string"}
    assert rows(out) == [(1, 1.0, "x"), (2, 2.0, "x"), (3, 1.5, "x")]


def test_all_missing_number_stays_missing(spark):
    df = spark.createDataFrame([(None, "x")], "a double, t string")
    assert rows(impute(df, *fit_fill_values(df))) == [(None, "x")]


def test_impute_rejects_unknown_and_unordered(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        impute(df, {}, {}, "mean")
    with pytest.raises(ValueError):
        impute(df, {}, {}, "ffill")


def test_fill_values_ignores_absent_columns(spark):
    assert rows(fill_values(spark.range(2), {"absent": 1.0}, {"gone": "x"})) == [(0,), (1,)]


@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("keys", [[], ["g"]])
@pytest.mark.parametrize("parts", [1, 3, 16])
def test_fill_along_matches_pandas(spark, direction, keys, parts):
    rng = np.random.default_rng(11)
    n = 600
    # One group holds most rows and spans many parts; gaps are long enough to cross several parts.
    data = [(int(rng.choice([0, 0, 0, 1, 2])), i, float(i) if rng.random() < 0.02 else None,
             f"t{i}" if rng.random() < 0.3 else None) for i in range(n)]
    rng.shuffle(data)
    data = [(int(g), int(i), None if v is None else float(v), t) for g, i, v, t in data]
    df = spark.createDataFrame(data, "g int, i int, v double, t string").repartition(5)
    got = fill_along(df, ["i"], keys, ["v", "t"], direction, parts).toPandas().sort_values("i")
    pdf = df.toPandas().sort_values("i")
    cells = pdf.groupby("g")[["v", "t"]] if keys else pdf[["v", "t"]]
    want = cells.ffill() if direction == "forward" else cells.bfill()
    assert got["v"].fillna(-1).tolist() == want["v"].fillna(-1).tolist()
    assert got["t"].fillna("-").tolist() == want["t"].fillna("-").tolist()


def test_fill_along_missing_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1, 5.0), (None, 2, None), (1, 3, None)], "g int, i int, v double")
    assert rows(fill_along(df, ["i"], ["g"], parts=3)) == [(1, 3, None), (None, 1, 5.0), (None, 2, 5.0)]


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    df = spark.createDataFrame([(float(i), i, 1) for i in range(200)], "s double, a int, b int").repartition(7)
    got = running_totals(df, "s", ["a", "b"], descending, parts=9).toPandas().sort_values("s", ascending=not descending)
    assert got["cum_a"].tolist() == got["a"].cumsum().tolist()
    assert got["cum_b"].tolist() == list(range(1, 201))


# --- transforms -----------------------------------------------------------------------------------------

def test_outlier_strategy_none_means_leave_alone(spark):
    assert transforms.outlier_strategy("x", {"x": None}) is None
    assert transforms.outlier_strategy("y", {"x": None}) == "capping"
    with pytest.raises(ValueError):
        transforms.outlier_strategy("x", {"x": "trim"})


def test_one_hot_names_unseen_and_missing(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "t string")
    cats = stats.fit_categories(df, ["t"])
    assert cats == {"t": ["a", "b", "nan"]}
    out = transforms.encode_one_hot(spark.createDataFrame([("a",), ("z",), (None,)], "t string"), cats)
    assert out.columns == ["t_a", "t_b", "t_nan"]
    assert [tuple(r) for r in out.collect()] == [(1.0, 0.0, 0.0), (0.0, 0.0, 0.0), (0.0, 0.0, 1.0)]
    with pytest.raises(ValueError):
        transforms.encode_one_hot(spark.range(1), cats)


def test_constant_column_scales_to_zero(spark):
    df = spark.range(4).select(F.lit(7.0).alias("x"))
    for strategy in ("minmax", "standard", "robust"):
        scaled = transforms.scale_columns(df, transforms.fit_scalers(df, ["x"], strategy))
        assert {r["x"] for r in scaled.collect()} == {0.0}


def test_scalers_fit_after_filling_with_the_median(spark):
    values = [1.0, 2.0, 9.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    filled = np.array([1.0, 2.0, 9.0, 2.0])
    s = transforms.fit_scalers(df, ["x"], "standard")["x"]
    assert (s["center"], s["scale"]) == (pytest.approx(filled.mean()), pytest.approx(filled.std()))
    r = transforms.fit_scalers(df, ["x"], "robust")["x"]
    low, mid, high = np.quantile(filled, [0.25, 0.5, 0.75])
    assert (r["center"], r["scale"]) == (pytest.approx(mid), pytest.approx(high - low))
    assert transforms.scale_columns(df, {"x": s}).filter("x IS NULL").count() == 1


def test_auto_scaler_choice(spark):
    x = np.linspace(0, 1, 400)
    df = spark.createDataFrame([(float(v), float(v**2), float(np.exp(4 * v)), None if i == 0 else float(np.exp(4 * v)))
                                for i, v in enumerate(x)], "even double, bent double, skewed double, gappy double")
    kinds = {c: s["kind"] for c, s in transforms.fit_scalers(df, df.columns, "auto").items()}
    assert kinds == {"even": "minmax", "bent": "robust", "skewed": "power", "gappy": "minmax"}
    assert transforms.fit_scalers(df, ["gappy"], "auto", skew_with_missing="skip")["gappy"]["kind"] == "power"


def test_unknown_scaling_and_off(spark):
    df = spark.range(3).select(F.col("id").cast("double").alias("x"))
    with pytest.raises(ValueError):
        transforms.fit_scalers(df, ["x"], "maxabs")
    assert transforms.fit_scalers(df, ["x"], None) == {} == transforms.fit_scalers(df, ["x"], "none")


def test_yeo_johnson_lambda_is_the_likelihood_maximum(spark):
    rng = np.random.default_rng(5)
    x = np.exp(rng.normal(0, 0.6, 3000))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = transforms.fit_yeo_johnson(df, {"x": F.col("x")})["x"]

    def fit(value):
        t = ((x + 1) ** value - 1) / value
        return -len(x) / 2 * np.log(t.var()) + (value - 1) * np.log1p(x).sum()

    grid = np.arange(lam - 0.5, lam + 0.5, 0.001)
    assert abs(grid[np.argmax([fit(g) for g in grid])] - lam) < 0.002


def test_power_scaled_column_is_standard(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(v),) for v in np.exp(rng.normal(0, 1, 2000))], "x double")
    out = np.array([r["x"] for r in transforms.scale_columns(df, transforms.fit_scalers(df, ["x"], "auto")).collect()])
    assert abs(out.mean()) < 1e-9 and out.std() == pytest.approx(1.0)
    # Raw skewness is above 4; the likelihood maximum is near, not at, zero skewness.
    assert abs(((out - out.mean()) ** 3).mean()) < 0.2


def test_lambda_beyond_the_first_grid(spark):
    rng = np.random.default_rng(2)
    x = 10 - np.exp(rng.normal(0, 0.4, 2000))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert transforms.fit_yeo_johnson(df, {"x": F.col("x")})["x"] > 2


# --- splits ---------------------------------------------------------------------------------------------

def test_holdout_sizes_shares_and_determinism(spark):
    df = spark.range(1001).select("id", (F.col("id") % 10 < 3).cast("int").alias("y"))
    train, test = holdout_split(df, ["id"], 0.2, "y")
    assert (train.count(), test.count()) == (800, 201)
    assert train.join(test, "id").count() == 0
    shares = {r["y"]: r["count"] for r in test.groupBy("y").count().collect()}
    assert shares == {0: 141, 1: 60}
    again = {r["id"] for r in holdout_split(df.repartition(13), ["id"], 0.2, "y")[1].collect()}
    assert again == {r["id"] for r in test.collect()}
    other = {r["id"] for r in holdout_split(df, ["id"], 0.2, "y", seed=1)[1].collect()}
    assert other != again


def test_holdout_falls_back_to_random_without_target(spark):
    df = spark.range(15)
    marked = mark_holdout(df, ["id"], 0.2, "absent")
    assert marked.filter("is_test").count() == 3


def test_missing_class_is_a_class(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 50, 1).alias("y"))
    _, test = holdout_split(df, ["id"], 0.2, "y")
    assert {r["y"]: r["count"] for r in test.groupBy("y").count().collect()} == {1: 10, None: 10}


def test_repeated_key_is_an_error(spark):
    df = spark.range(500).select(F.lit(1).alias("k"))
    with pytest.raises(ValueError, match="repeats"):
        mark_holdout(df, ["k"], 0.5)


@pytest.mark.parametrize("n,k", [(100, 3), (7, 7), (5, 7), (1, 2), (1000, 10)])
def test_folds_are_even_and_cover(spark, n, k):
    sizes = [r["count"] for r in mark_folds(spark.range(n), ["id"], k).groupBy("fold").count().collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and len(sizes) == min(n, k)


def test_stratified_folds(spark):
    df = spark.range(100).select("id", (F.col("id") % 4 == 0).alias("y"))
    counts = mark_folds(df, ["id"], 5, "y").groupBy("fold", "y").count().collect()
    assert {r["count"] for r in counts if r["y"]} == {5} and {r["count"] for r in counts if not r["y"]} == {15}


def test_deep_threshold_search(spark, monkeypatch):
    """Narrow slices force several rounds; the result must not change."""
    from tablewright.operators import split

    df = spark.range(3000)
    want = {r["id"] for r in mark_holdout(df, ["id"], 0.3).filter("is_test").collect()}
    monkeypatch.setattr(split, "SLICE_BITS", 2)
    monkeypatch.setattr(split, "LEAF_ROWS", 3)
    assert {r["id"] for r in mark_holdout(df, ["id"], 0.3).filter("is_test").collect()} == want
    folds = mark_folds(df, ["id"], 3).groupBy("fold").count().collect()
    assert {r["count"] for r in folds} == {1000}


# --- metrics --------------------------------------------------------------------------------------------

def scored(spark, data):
    return spark.createDataFrame(data, "fold int, label int, prediction int, score double")


def test_metrics_zero_division_and_no_folds(spark):
    nothing = scored(spark, [(0, 0, 0, 0.1)])
    assert tuple(metrics.binary_metrics(nothing).first()) == (1.0, 0.0, 0.0, 0.0)
    empty = metrics.mean_metrics(nothing.limit(0)).first()
    assert empty["mean_accuracy"] == 0.0 and empty["n_folds"] == 0


def test_confusion_matrix_is_dense(spark):
    assert rows(metrics.confusion_matrix(scored(spark, [(0, 1, 1, 0.9)]))) == [
        (0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 1)]


def test_auc_matches_the_evaluator_and_roc_rises(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(1)
    # + 0.0 turns -0.0 into 0.0: they are one score here, but two to the evaluator.
    data = [(0, int(y), 0, float(np.round(rng.normal(y, 1.5), 1) + 0.0)) for y in rng.integers(0, 2, 3000)]
    df = scored(spark, data)
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    assert metrics.auc(df).first()["auc"] == pytest.approx(want)
    points = metrics.roc_points(df).toPandas().sort_values("threshold", ascending=False)
    assert points["fpr"].is_monotonic_increasing and points["tpr"].is_monotonic_increasing
    assert tuple(points.iloc[0]) == (float("inf"), 0.0, 0.0) and tuple(points.iloc[-1])[1:] == (1.0, 1.0)


def test_auc_without_one_class_is_missing(spark):
    assert metrics.auc(scored(spark, [(0, 1, 1, 0.5)])).first()["auc"] is None


def test_leaderboard_order_and_champion(spark):
    tables = {name: spark.createDataFrame([(0.5, f1)], "mean_accuracy double, mean_f1_score double")
              for name, f1 in (("a", 0.1), ("b", 0.9), ("c", 0.9))}
    board = metrics.leaderboard(tables)
    assert [r["model"] for r in board.collect()] == ["b", "c", "a"]
    assert tuple(metrics.champion(board).first()) == ("b", 0.9)
    with pytest.raises(ValueError):
        metrics.leaderboard({})
    plain = metrics.leaderboard({n: t.drop("mean_f1_score") for n, t in tables.items()})
    assert [r["model"] for r in plain.collect()] == ["a", "b", "c"]


def test_categories_without_end_are_refused_by_name(spark):
    df = spark.range(300).selectExpr("cast(id as string) AS free", "cast(id % 3 as string) AS few")
    with pytest.raises(ValueError, match="free"):
        stats.fit_categories(df, ["few", "free"], limit=200)
    assert len(stats.fit_categories(df, ["few", "free"], limit=None)["free"]) == 300
    assert stats.MAX_CATEGORIES == 100_000
