"""Preparation of a raw table: clean, add features, split, fit on the training part, transform both."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.columns import row_sum
from tablewright.operators.split import mark_holdout
from tablewright.plans.cleaner import Cleaner, CleanerConfig, CleanerModel
from tablewright.plans.transformer import Transformer, TransformerConfig, TransformerModel
from tablewright.session import Scratch, materialise

ROW_KEY = "__row_key"


@dataclass(frozen=True)
class PrepareConfig:
    """``sums`` are the engineered features: new column -> columns added up row by row.

    ``key`` names the unique column behind the split. The cleaner may drop it as a feature; a copy travels
    along as ``__row_key`` and is left out of every statistic. Without a key the rows are numbered.
    """

    cleaner: CleanerConfig = field(default_factory=CleanerConfig)
    transformer: TransformerConfig = field(default_factory=TransformerConfig)
    sums: dict[str, tuple[str, ...]] = field(default_factory=dict)
    target_col: str | None = None
    key: str | None = None
    test_size: float = 0.2
    seed: int = 42
    split_first: bool = False
    keep_key: bool = False


@dataclass(frozen=True)
class Prepared:
    train: DataFrame
    test: DataFrame
    cleaner: CleanerModel
    transformer: TransformerModel

    scratch: Scratch | None = None

    def release(self) -> None:
        """Delete all intermediate tables that the preparation wrote; ``train`` and ``test`` read them until then."""
        if self.scratch is not None:
            self.scratch.release()


def _engineer(df: DataFrame, sums: dict) -> DataFrame:
    for out, names in sums.items():
        df = row_sum(df, names, out)
    return df


def _keyed(df: DataFrame, key: str | None) -> DataFrame:
    """Add the row key. Numbered rows are written first: the numbers must not change when a task is rerun."""
    if key is not None:
        return df.withColumn(ROW_KEY, F.col(key))
    return materialise(df.withColumn(ROW_KEY, F.monotonically_increasing_id()), "keyed")


def _columnar(df: DataFrame, drop) -> DataFrame:
    """The columns that are needed, written once if ``df`` is parsed from text files: every fit below would parse them again."""
    needed = df.drop(*drop)
    if all(file.endswith(".parquet") for file in df.inputFiles()):
        return needed
    return materialise(needed, "raw")


def prepare(raw: DataFrame, config: PrepareConfig) -> Prepared:
    scratch = Scratch(raw.sparkSession).open()
    try:
        train, test, cleaned, fitted = _prepare(raw, config)
    except BaseException:
        scratch.release()
        raise
    return Prepared(train, test, cleaned, fitted, scratch.close())


def _prepare(raw: DataFrame, config: PrepareConfig) -> tuple[DataFrame, DataFrame, CleanerModel, TransformerModel]:
    cfg = config
    drop = [c for c in cfg.cleaner.cols_to_drop if c not in (cfg.key, cfg.target_col)]
    df = _keyed(_columnar(raw, drop) if cfg.key is not None else raw.drop(*drop), cfg.key)
    settings = {**cfg.cleaner.__dict__, "row_key": ROW_KEY}
    cleaner = Cleaner(CleanerConfig(**settings))

    if cfg.split_first:
        marked = materialise(mark_holdout(df, [ROW_KEY], cfg.test_size, cfg.target_col, cfg.seed, "__test"), "split")
        raw_train, raw_test = (marked.filter(F.col("__test") == side).drop("__test") for side in (False, True))
        cleaned, train = cleaner.fit_clean(raw_train)
        train, test = (_engineer(part, cfg.sums) for part in (train, cleaned.transform(raw_test)))
    else:
        cleaned, whole = cleaner.fit_clean(df)
        whole = _engineer(whole, cfg.sums)
        if cfg.cleaner.imputation_strategy != "auto":
            whole = materialise(whole, "filled")
        # From the written cleaned table on, everything is a projection: the fits below read it a few
        # columns at a time, and computing a digest again costs less than writing the table again.
        marked = mark_holdout(whole, [ROW_KEY], cfg.test_size, cfg.target_col, cfg.seed, "__test")
        train, test = (marked.filter(F.col("__test") == side).drop("__test") for side in (False, True))

    ignore = [*cfg.transformer.ignore_cols, ROW_KEY]
    settings = {**cfg.transformer.__dict__, "ignore_cols": ignore}
    fitted = Transformer(TransformerConfig(**settings)).fit(train)
    train, test = fitted.transform(train), fitted.transform(test)
    if not cfg.keep_key:
        train, test = train.drop(ROW_KEY), test.drop(ROW_KEY)
    return train, test, cleaned, fitted
