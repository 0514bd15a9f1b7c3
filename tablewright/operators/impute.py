"""Filling of missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.columns import is_integral, numeric_columns, q, replace_columns, text_columns
from tablewright.operators.ordered import fill_along
from tablewright.operators.quantiles import exact_medians
from tablewright.operators.stats import fit_modes

STRATEGIES = ("auto", "ffill", "bfill")


def fit_fill_values(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[dict, dict]:
    """Medians of the numeric columns and modes of the text columns, without ``exclude``."""
    return exact_medians(df, numeric_columns(df, exclude)), fit_modes(df, text_columns(df, exclude))


def fill_values(df: DataFrame, medians: Mapping, modes: Mapping) -> DataFrame:
    """Fill with fitted values. An integer column turns double only if its fill value has a fraction."""
    types = {f.name: f.dataType for f in df.schema}
    out = {}
    for c, value in medians.items():
        if c not in types or value is None:
            continue
        whole = is_integral(types[c]) and float(value).is_integer()
        fill = F.lit(int(value)).cast(types[c]) if whole else F.lit(float(value))
        out[c] = F.coalesce(q(c), fill)
    for c, value in modes.items():
        if c in types:
            out[c] = F.coalesce(q(c).cast("string"), F.lit(value))
    return replace_columns(df, out)


def impute(df: DataFrame, medians: Mapping, modes: Mapping, strategy: str = "auto",
           order_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> DataFrame:
    """``auto`` fills with median and mode; ``ffill`` and ``bfill`` carry neighbours first."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown imputation strategy {strategy!r}")
    if strategy != "auto":
        if not order_by:
            raise ValueError(f"{strategy} needs order_by: a distributed table has no row order of its own")
        df = fill_along(df, order_by, partition_by, direction="forward" if strategy == "ffill" else "backward")
    return fill_values(df, medians, modes)
