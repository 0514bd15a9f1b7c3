"""AutoML over prepared tables: select features, then tune, refit and score each model, and rank them."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.columns import split_target
from tablewright.operators.metrics import champion, leaderboard, mean_metrics, score_column
from tablewright.operators.models import SUPPORTED_MODELS, build_model, predict, save_model, train_model
from tablewright.operators.select import assemble, select_features
from tablewright.operators.split import mark_folds
from tablewright.operators.tune import tune_or_default
from tablewright.plans.prepare import ROW_KEY, PrepareConfig, prepare
from tablewright.session import Scratch, materialise
from tablewright.sources.reader import load_table
from tablewright.sources.writer import write_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class AutoMLConfig:
    """``grids`` replaces the search grid of single models; ``key`` is the unique row key of the tables."""

    target_col: str = "OUTCOME"
    tuning_method: str = "random_search"
    feature_method: str = "rfe"
    n_features: int = 15
    models: Sequence[str] = SUPPORTED_MODELS
    grids: Mapping[str, Sequence[Mapping]] = field(default_factory=dict)
    n_folds: int = 3
    n_iter: int = 10
    seed: int = 42
    key: str = ROW_KEY
    base_model: object = None
    save_dir: str | None = None
    parallelism: int = 8


@dataclass
class AutoMLResult:
    """``leaderboard`` and ``champion`` are None if every model failed; ``status`` tells what happened."""

    selected: list[str]
    leaderboard: DataFrame | None
    champion: DataFrame | None
    scored: dict[str, DataFrame]
    params: dict[str, dict]
    status: dict[str, str]
    scratch: Scratch | None = None

    def release(self) -> None:
        """Delete the intermediate tables of the run; read or save the tables above before."""
        if self.scratch is not None:
            self.scratch.release()


def run_automl(train: DataFrame, test: DataFrame, config: AutoMLConfig) -> AutoMLResult:
    scratch = Scratch(train.sparkSession).open()
    try:
        result = _run_automl(train, test, config)
    except BaseException:
        scratch.release()
        raise
    result.scratch = scratch.close()
    return result


def _run_automl(train: DataFrame, test: DataFrame, config: AutoMLConfig) -> AutoMLResult:
    cfg = config
    features, target = split_target(train, cfg.target_col, drop=("ID", cfg.key))
    split_target(test, cfg.target_col)
    if cfg.key not in train.columns:
        raise ValueError(f"key column {cfg.key!r} is missing; prepare with keep_key=True")
    selected = select_features(train, features, target, cfg.feature_method, cfg.n_features, cfg.base_model,
                               [cfg.key], cfg.n_folds, cfg.seed, cfg.parallelism)

    # Folds and vectors are the same for all models: made once, kept for every fit.
    folded = mark_folds(train, [cfg.key], cfg.n_folds, seed=cfg.seed)
    fit_on = assemble(folded, selected, target, [cfg.key, "fold"]).persist(StorageLevel.MEMORY_AND_DISK)
    score_on = assemble(test, selected, target, [cfg.key]).persist(StorageLevel.MEMORY_AND_DISK)
    tables, scored, params, status = {}, {}, {}, {}
    try:
        n_rows = fit_on.count()
        for name in cfg.models:
            try:
                found = tune_or_default(
                    name, fit_on, method=cfg.tuning_method, n_folds=cfg.n_folds, grid=cfg.grids.get(name),
                    n_iter=cfg.n_iter, seed=cfg.seed, key_col=cfg.key, parallelism=cfg.parallelism)
                params[name], status[name] = found.best_params, found.status
                # The search already refitted its winner on all training rows.
                model = found.best_model or train_model(
                    build_model(name, n_rows, key_col=cfg.key), fit_on)
                if cfg.save_dir:
                    save_model(model, cfg.save_dir, name)
                output = predict(model, score_on)
                scored[name] = materialise(output.select(
                    F.lit(0).alias("fold"), cfg.key, "label", "prediction", score_column(output).alias("score")), "scored")
                tables[name] = mean_metrics(scored[name])
            except Exception as error:  # a failing model is left out, the others go on
                log.warning("model %s failed: %s", name, error)
                status[name] = f"{type(error).__name__}: {error}".splitlines()[0]
    finally:
        fit_on.unpersist()
        score_on.unpersist()
    board = leaderboard(tables) if tables else None
    return AutoMLResult(selected, board, champion(board) if board is not None else None, scored, params, status)


def save_report(result: AutoMLResult, path: str, format: str = "json") -> str | None:
    """Write the leaderboard with the champion marked; without results nothing is written."""
    if result.leaderboard is None:
        log.warning("no results to report")
        return None
    best = result.champion.first()["model"]
    return write_table(result.leaderboard.withColumn("champion", F.col("model") == best).coalesce(1), path, format,
                       mode="overwrite")


def risk_run(spark, path: str, prepare_config: PrepareConfig, automl_config: AutoMLConfig, out_dir: str,
             **read_options) -> AutoMLResult:
    """From file to leaderboard: load, prepare, write both tables, run AutoML on them, write the report."""
    from dataclasses import replace

    prepared = prepare(load_table(spark, path, **read_options), replace(prepare_config, keep_key=True))
    write_table(prepared.train, f"{out_dir}/train.parquet", mode="overwrite")
    write_table(prepared.test, f"{out_dir}/test.parquet", mode="overwrite")
    train = load_table(spark, f"{out_dir}/train.parquet")
    test = load_table(spark, f"{out_dir}/test.parquet")
    result = run_automl(train, test, replace(automl_config, key=ROW_KEY))
    save_report(result, f"{out_dir}/leaderboard.json")
    return result
