"""The cleaner: drop, deduplicate, absolute values, categories, ages, ranges, imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame

from tablewright.functions.fuzzy import canonicalise_columns
from tablewright.functions.text import NULL_TOKENS, age_bucket, normalise_text, null_tokens
from tablewright.operators.columns import absolute, drop_columns, numeric_columns, q, replace_columns, text_columns
from tablewright.operators.dedup import drop_duplicate_rows
from tablewright.operators.impute import STRATEGIES, impute
from tablewright.operators.quantiles import exact_medians
from tablewright.operators.ranges import enforce_ranges
from tablewright.operators.stats import fit_modes
from tablewright.session import materialise, run_together


@dataclass(frozen=True)
class CleanerConfig:
    """Rules of the cleaner.

    ``row_key``            unique column to carry along, outside duplicate removal and imputation
    ``protect_golden``     a null token that is also a golden value of the column stays a value
    ``fit_on``             "raw": medians and modes of the table as loaded; "cleaned": after the ranges step
    ``exclude_from_numeric``  numeric columns that absolute value and imputation leave alone
    ``order_by``, ``partition_by``  row order for the ffill and bfill strategies
    """

    golden_specs: Mapping[str, Sequence[str]] = field(default_factory=dict)
    range_rules: Mapping[str, tuple] = field(default_factory=dict)
    cols_to_drop: Sequence[str] = ()
    fuzzy_threshold: float = 90
    fuzzy_scorer: str = "weighted"
    max_drop_ratio: float = 0.05
    imputation_strategy: str = "auto"
    order_by: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    age_col: str = "AGE"
    null_tokens: Sequence[str] = NULL_TOKENS
    protect_golden: bool = False
    fit_on: str = "raw"
    row_key: str | None = None
    exclude_from_numeric: Sequence[str] = ()


class Cleaner:
    """``Cleaner(config).fit(df)`` learns fill values; the model cleans tables of the same shape."""

    def __init__(self, config: CleanerConfig | None = None, **settings):
        self.config = config or CleanerConfig(**settings)
        if self.config.imputation_strategy not in STRATEGIES:
            raise ValueError(f"unknown imputation strategy {self.config.imputation_strategy!r}")
        if self.config.fit_on not in ("raw", "cleaned"):
            raise ValueError(f"unknown fit_on {self.config.fit_on!r}")

    def _unfitted(self, df: DataFrame) -> CleanerModel:
        return CleanerModel(self.config, numeric_columns(df, [*self._skipped(), *self.config.exclude_from_numeric]), {}, {})

    def _skipped(self) -> set:
        # A dropped column is never filled, so its statistics are not worth a pass.
        return {*self.config.cols_to_drop, self.config.row_key}

    def _learn(self, model: CleanerModel, source: DataFrame) -> CleanerModel:
        numbers = [c for c in numeric_columns(source) if c in model.numeric]
        texts = text_columns(source, self._skipped())
        medians, modes = run_together(source.sparkSession, lambda: exact_medians(source, numbers),
                                      lambda: fit_modes(source, texts))
        return CleanerModel(self.config, model.numeric, medians, modes)

    def fit(self, df: DataFrame) -> CleanerModel:
        model = self._unfitted(df)
        return self._learn(model, df if self.config.fit_on == "raw" else model.checked(df))

    def fit_clean(self, df: DataFrame) -> tuple[CleanerModel, DataFrame]:
        """Model and cleaned table. The checks do not depend on the fill values, so both run side by
        side, or, fitted on the cleaned table, share it."""
        model = self._unfitted(df)
        if self.config.fit_on == "raw":
            fitted, checked = run_together(df.sparkSession, lambda: self._learn(model, df), lambda: model.checked(df))
        else:
            checked = model.checked(df)
            fitted = self._learn(model, checked)
        return fitted, fitted.filled(checked)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit_clean(df)[1]


@dataclass(frozen=True)
class CleanerModel:
    config: CleanerConfig
    numeric: list[str]
    medians: dict[str, float | None]
    modes: dict[str, str]

    def standardise(self, df: DataFrame, source: DataFrame | None = None) -> DataFrame:
        """The row-wise steps on text: normalise, null tokens, fuzzy repair, ages.

        ``source`` holds the same texts as ``df`` or more and is cheaper to read; the values to repair are sought there.
        """
        categories = {c: golden for c, golden in self.config.golden_specs.items() if c != self.config.age_col and c in df.columns}
        return canonicalise_columns(self._texts(df), categories, self.config.fuzzy_threshold, self.config.fuzzy_scorer,
                                    None if source is None else self._texts(source))

    def _texts(self, df: DataFrame) -> DataFrame:
        cfg = self.config
        if cfg.age_col in df.columns and cfg.age_col not in cfg.golden_specs:
            raise ValueError(f"golden_specs must list the valid labels of {cfg.age_col!r}")
        specs = {c: golden for c, golden in cfg.golden_specs.items() if c in df.columns}
        # Two projections, so that a text is normalised once and not at each of its uses below.
        df = replace_columns(df, {c: normalise_text(q(c)) for c in specs})
        changes = {}
        for c, golden in specs.items():
            tokens = [t for t in cfg.null_tokens if c == cfg.age_col or not (cfg.protect_golden and t in golden)]
            text = null_tokens(q(c), tokens)
            changes[c] = age_bucket(text, golden) if c == cfg.age_col else text
        return replace_columns(df, changes)

    def checked(self, df: DataFrame, write: bool = True) -> DataFrame:
        """All steps up to the range rules. The standardised table is written once, for the rules count
        it before they filter it, and fits that follow would repeat the duplicate removal."""
        cfg = self.config
        out = drop_columns(df, [c for c in cfg.cols_to_drop if c != cfg.row_key])
        once = drop_duplicate_rows(out, cfg.row_key if cfg.row_key in out.columns else None)
        out = self.standardise(absolute(once, self.numeric), source=out)
        if write:
            out = materialise(out, "cleaned")
        return enforce_ranges(out, cfg.range_rules, cfg.max_drop_ratio)

    def filled(self, checked: DataFrame) -> DataFrame:
        cfg = self.config
        return impute(checked, self.medians, self.modes, cfg.imputation_strategy, cfg.order_by, cfg.partition_by)

    def transform(self, df: DataFrame, write: bool = True) -> DataFrame:
        return self.filled(self.checked(df, write))

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, state: Mapping) -> CleanerModel:
        cfg = dict(state["config"])
        cfg["range_rules"] = {c: tuple(b) for c, b in cfg["range_rules"].items()}
        return cls(CleanerConfig(**cfg), list(state["numeric"]), dict(state["medians"]), dict(state["modes"]))
