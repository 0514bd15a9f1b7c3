"""The transformer: bins, outliers, encodings, scaling. Two rounds of aggregates fit it, one projection applies it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame

from tablewright.operators.columns import numeric_columns, require
from tablewright.operators.quantiles import exact_quantiles
from tablewright.operators.stats import MAX_CATEGORIES, edge_probs, fit_categories, merge_edges
from tablewright.operators.transforms import (
    bin_columns,
    encode_one_hot,
    encode_ordinal,
    fit_scalers,
    outlier_strategy,
    scale_columns,
    treat_outliers,
)
from tablewright.session import run_together


@dataclass(frozen=True)
class TransformerConfig:
    scaling_strategy: str | None = "auto"
    default_outlier_strategy: str | None = "capping"
    capping_quantiles: tuple[float, float] = (0.01, 0.99)
    outlier_strategies: Mapping[str, str | None] = field(default_factory=dict)
    binning_cols: Sequence[str] = ()
    n_bins: int = 5
    ordinal_mappings: Mapping[str, Mapping] = field(default_factory=dict)
    unmapped: float = 0.0
    nominal_cols: Sequence[str] = ()
    ignore_cols: Sequence[str] = ()
    skew_with_missing: str = "minmax"
    max_categories: int | None = MAX_CATEGORIES


class Transformer:
    def __init__(self, config: TransformerConfig | None = None, **settings):
        self.config = config or TransformerConfig(**settings)

    def fit(self, df: DataFrame) -> TransformerModel:
        """Learn edges, caps and categories from the raw columns, then scalers from the treated ones."""
        cfg = self.config
        require(df, cfg.nominal_cols, "nominal columns")
        numeric = numeric_columns(df, [*cfg.binning_cols, *cfg.nominal_cols, *cfg.ignore_cols])
        choice = {c: outlier_strategy(c, cfg.outlier_strategies, cfg.default_outlier_strategy) for c in numeric}
        binned = [c for c in cfg.binning_cols if c in df.columns]
        capped = [c for c in numeric if choice[c] == "capping" and c not in binned]
        # Edges and limits share the passes of one search.
        found, categories = run_together(
            df.sparkSession,
            lambda: exact_quantiles(df, edge_probs(binned, cfg.n_bins) | {c: list(cfg.capping_quantiles) for c in capped}),
            lambda: fit_categories(df, cfg.nominal_cols, cfg.max_categories))
        edges = merge_edges({c: found[c] for c in binned})
        caps = {c: tuple(found[c]) for c in capped if found[c][0] is not None}
        model = TransformerModel(cfg, numeric, edges, caps, categories, {})
        scalers = fit_scalers(model.unscaled(df), numeric, cfg.scaling_strategy,
                              [*cfg.ordinal_mappings, *cfg.binning_cols], cfg.skew_with_missing)
        return TransformerModel(cfg, numeric, edges, caps, categories, scalers)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


@dataclass(frozen=True)
class TransformerModel:
    config: TransformerConfig
    numeric: list[str]
    edges: dict[str, list[float]]
    caps: dict[str, tuple[float, float]]
    categories: dict[str, list[str]]
    scalers: dict[str, dict]

    def unscaled(self, df: DataFrame) -> DataFrame:
        cfg = self.config
        out = bin_columns(df, self.edges)
        out = treat_outliers(out, [c for c in self.numeric if c in df.columns], cfg.outlier_strategies, self.caps,
                             cfg.default_outlier_strategy)
        out = encode_ordinal(out, cfg.ordinal_mappings, cfg.unmapped)
        return encode_one_hot(out, self.categories)

    def transform(self, df: DataFrame) -> DataFrame:
        """A pure projection: no shuffle, and valid on a stream."""
        return scale_columns(self.unscaled(df), self.scalers)

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, state: Mapping) -> TransformerModel:
        cfg = dict(state["config"])
        cfg["capping_quantiles"] = tuple(cfg["capping_quantiles"])
        caps = {c: tuple(v) for c, v in state["caps"].items()}
        return cls(TransformerConfig(**cfg), list(state["numeric"]), dict(state["edges"]), caps,
                   dict(state["categories"]), dict(state["scalers"]))
