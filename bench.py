"""Time the headline stages on local[$BENCH_CPUS] and print one JSON line.

The stages follow the published run: preparation of the risk table step by step and from the file, feature elimination 17 -> 15,
searches, final fits with the published best parameters, and predictions.

Two things are cut, and only these: the forest of the elimination is 10 levels deep, as the stage's name says (the default is deeper), and the searches
of forest, boosting and kNN, most of the published time, run only with ``BENCH_ALL_SEARCHES=1``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tablewright.operators import metrics, models, split, tune
from tablewright.operators.columns import split_target
from tablewright.operators.quantiles import exact_quantiles
from tablewright.operators.select import assemble, default_base_model, select_features
from tablewright.operators.transforms import fit_scalers, scale_columns
from tablewright.plans.cleaner import Cleaner
from tablewright.plans.prepare import ROW_KEY, prepare
from tablewright.plans.risk import TARGET, risk_cleaner, risk_prepare
from tablewright.plans.views import table, view
from tablewright.session import materialise, scratch_path
from tablewright.sources import load_table, write_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SEARCHES = ("logistic_regression", "svm", "decision_tree")
if os.environ.get("BENCH_ALL_SEARCHES") == "1":
    SEARCHES += ("random_forest", "xgboost", "knn")

# The best parameters of the published run.
BEST = {
    "logistic_regression": {"C": 10},
    "svm": {"penalty": "l1", "C": 0.1},
    "decision_tree": {"criterion": "entropy", "max_depth": 10, "min_samples_leaf": 1},
    "random_forest": {"n_estimators": 100, "max_depth": 10, "min_samples_leaf": 1},
    "xgboost": {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.2, "subsample": 0.8, "colsample_bytree": 0.8},
    "knn": {"n_neighbors": 11, "weights": "distance", "p": 1},
}


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, job):
        start = time.perf_counter()
        result = job()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)
        return result

    # Start-up of the session and of the Python workers is not part of any stage.
    noop(Cleaner(risk_cleaner()).fit_transform(view(spark, SF_DIR, "risk")))

    raw_csv = write_table(view(spark, SF_DIR, "risk"), scratch_path(spark, "bench") + ".csv", "csv")
    raw = timed("read_csv", lambda: materialise(load_table(spark, raw_csv)))
    cleaner = Cleaner(risk_cleaner(row_key="ID"))
    timed("cleaner_fit", lambda: cleaner.fit(raw))
    timed("clean", lambda: noop(cleaner.fit_transform(raw)))
    # From the file on, inference of the types included, as the published preparation is.
    done = timed("prepare", lambda: prepare(load_table(spark, raw_csv), risk_prepare(keep_key=True)))
    timed("write_prepared", lambda: [write_table(df, scratch_path(spark, "bench"), "csv") for df in (done.train, done.test)])

    events, lines = table(spark, SF_DIR, "events"), table(spark, SF_DIR, "lineitem")
    timed("quantiles", lambda: exact_quantiles(lines, {"l_extendedprice": [0.01, 0.5, 0.99], "l_quantity": [0.5]}))
    timed("scale_power", lambda: noop(scale_columns(events, fit_scalers(events, ["value"], "auto"))))
    timed("folds", lambda: noop(split.mark_folds(table(spark, SF_DIR, "orders"), ["o_orderkey"], 3)))
    timed("auc", lambda: metrics.auc(view(spark, SF_DIR, "scored")).collect())

    features, _ = split_target(done.train, TARGET, drop=(ROW_KEY,))
    train_rows = materialise(done.train)
    selected = timed("select_rfe_depth_10", lambda: select_features(train_rows, features, TARGET, "rfe", 15, default_base_model(max_depth=10)))
    folded = split.mark_folds(train_rows, [ROW_KEY], 3)
    train = assemble(folded, selected, TARGET, [ROW_KEY, "fold"]).persist()
    test = assemble(done.test, selected, TARGET, [ROW_KEY]).persist()
    n_rows = train.count()
    test.count()
    for name in SEARCHES:
        timed(f"tune_{name}", lambda name=name: tune.tune(name, train, "random_search", key_col=ROW_KEY))
    for name, params in BEST.items():
        model = timed(f"fit_{name}", lambda name=name, params=params: models.train_model(
            models.build_model(name, n_rows, key_col=ROW_KEY, **params), train))
        timed(f"predict_{name}", lambda model=model: noop(models.predict(model, test).select(ROW_KEY, "prediction")))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "train_rows": n_rows}))
    spark.stop()


if __name__ == "__main__":
    main()
