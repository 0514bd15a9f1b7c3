"""Outlier treatment, binning, encoding and scaling: fitted numbers in, one projection out."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.numeric import bin_index, clip, divide, log_positive, yeo_johnson
from tablewright.functions.text import category_text, map_values
from tablewright.operators.columns import q, replace_columns, require
from tablewright.operators.quantiles import exact_medians, exact_quantiles
from tablewright.operators.stats import fit_moments

OUTLIER_STRATEGIES = ("capping", "log", "none", None)
SCALING_STRATEGIES = ("auto", "standard", "robust", "minmax", "none", None)


# --- outliers -------------------------------------------------------------------------------------------

def outlier_strategy(column: str, strategies: Mapping, default: str | None = "capping"):
    """An explicit entry wins, also if it is None (leave alone); otherwise the default."""
    choice = strategies.get(column, default)
    if choice not in OUTLIER_STRATEGIES:
        raise ValueError(f"unknown outlier strategy {choice!r} for {column!r}")
    return choice


def fit_caps(df: DataFrame, columns: Sequence[str], quantiles=(0.01, 0.99)) -> dict[str, tuple]:
    found = exact_quantiles(df, {c: list(quantiles) for c in columns})
    return {c: (low, high) for c, (low, high) in found.items() if low is not None}


def outlier_exprs(columns: Sequence[str], strategies: Mapping, caps: Mapping, default="capping") -> dict[str, Column]:
    out = {}
    for c in columns:
        choice = outlier_strategy(c, strategies, default)
        if choice == "log":
            out[c] = log_positive(q(c))
        elif choice == "capping" and c in caps:
            out[c] = clip(q(c), *caps[c])
    return out


def treat_outliers(df: DataFrame, columns: Sequence[str], strategies: Mapping, caps: Mapping,
                   default="capping") -> DataFrame:
    return replace_columns(df, outlier_exprs(columns, strategies, caps, default))


# --- bins and codes -------------------------------------------------------------------------------------

def bin_columns(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Value to bin number: right-open bins, the first and last are open-ended."""
    return replace_columns(df, {c: bin_index(q(c), e[1:-1]) for c, e in edges.items() if c in df.columns})


def encode_ordinal(df: DataFrame, mappings: Mapping[str, Mapping], unmapped: float = 0.0) -> DataFrame:
    return replace_columns(df, {c: map_values(q(c), m, unmapped) for c, m in mappings.items() if c in df.columns})


def encode_one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Append a 0/1 column ``NAME_value`` per category and drop the source columns.

    A value that was not seen at fit gives zeros throughout.
    """
    require(df, list(categories), "nominal columns")
    codes = [F.when(category_text(q(c)) == v, 1.0).otherwise(0.0).alias(f"{c}_{v}")
             for c, values in categories.items() for v in values]
    return df.select(*[q(c) for c in df.columns if c not in categories], *codes)


# --- scalers --------------------------------------------------------------------------------------------

def scale_expr(c: Column, scaler: Mapping) -> Column:
    """Apply one fitted scaler; missing stays missing."""
    kind = scaler["kind"]
    if kind == "power":
        c = yeo_johnson(c, scaler["lambda"])
    return divide(c.cast("double") - F.lit(float(scaler["center"])), float(scaler["scale"]))


def scale_columns(df: DataFrame, scalers: Mapping[str, Mapping]) -> DataFrame:
    return replace_columns(df, {c: scale_expr(q(c), s) for c, s in scalers.items() if c in df.columns})


def _power_variances(df: DataFrame, exprs: Mapping[int, Column], grids: Mapping[int, Sequence[float]]) -> dict:
    """{(column number, grid position): variance of the transformed column}.

    The lambdas are data, not code: an array literal keeps the compiled plan the same from round to round. Each value is
    transformed once per grid point within its row, and each grid point is one aggregate.
    """
    def powers(x: Column, grid: Sequence[float]) -> Column:
        def power(lam: Column) -> Column:
            rest = 2.0 - lam
            upper = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1.0, lam) - 1.0) / lam)
            lower = F.when(F.abs(rest) < 1e-12, -F.log1p(-x)).otherwise(-(F.pow(1.0 - x, rest) - 1.0) / rest)
            return F.when(x >= 0, upper).otherwise(lower)

        return F.when(x.isNotNull(), F.transform(F.array(*[F.lit(g) for g in grid]), power))

    transformed = df.select(*[powers(e.cast("double"), grids[i]).alias(f"p{i}") for i, e in exprs.items()])
    row = transformed.agg(*[F.var_pop(F.get(f"p{i}", F.lit(k))).alias(f"v{i}_{k}") for i in exprs for k in range(len(grids[i]))]).first()
    return {(i, k): row[f"v{i}_{k}"] for i in exprs for k in range(len(grids[i])) if row[f"v{i}_{k}"] is not None}


def _vertex(fit: Sequence[float], best: int) -> float:
    """Top of the parabola through the best point and its neighbours, in grid steps from the best."""
    left, top, right = fit[best - 1:best + 2]
    bend = left - 2 * top + right
    return 0.5 * (left - right) / bend if math.isfinite(bend) and bend < 0 else 0.0


def fit_yeo_johnson(df: DataFrame, exprs: Mapping[str, Column], points: int = 9, rounds: int = 3) -> dict[str, float]:
    """Maximum-likelihood lambda per column.

    One aggregate per round evaluates a grid of lambdas for all columns. The likelihood is smooth, so the
    next grid, ten times finer, is centred on the top of the parabola through the best three points; a
    best point at the edge moves the grid instead. A column without a finite likelihood (its values are all equal, or infinite), and
    a search that does not settle, are errors.
    """
    names, half = list(exprs), points // 2
    centre, step = {c: 0.0 for c in exprs}, {c: 0.5 for c in exprs}
    sums = df.agg(*[F.sum(F.signum(e) * F.log1p(F.abs(e))).alias(f"s{i}") for i, e in enumerate(exprs.values())],
                  *[F.count(e).alias(f"n{i}") for i, e in enumerate(exprs.values())]).first()
    left, moves = {c: rounds for c in names}, 0
    while any(left.values()) and moves < 60:
        moves += 1
        active = [i for i, c in enumerate(names) if left[c]]
        grids = {i: [centre[names[i]] + k * step[names[i]] for k in range(-half, half + 1)] for i in active}
        variances = _power_variances(df, {i: exprs[names[i]] for i in active}, grids)
        for i in active:
            c, n, s = names[i], sums[f"n{i}"], sums[f"s{i}"]
            values = [variances.get((i, k)) for k in range(points)]
            fit = [-n / 2 * math.log(v) + (lam - 1) * s if v is not None and 0 < v < math.inf else -math.inf
                   for lam, v in zip(grids[i], values)]
            best = max(range(points), key=fit.__getitem__)
            if fit[best] == -math.inf:
                raise ValueError(f"no power transform of {c!r} has a finite likelihood")
            centre[c] = grids[i][best]
            if 0 < best < points - 1:
                centre[c] += step[c] * _vertex(fit, best)
                step[c] /= 10
                left[c] -= 1
    unsettled = [c for c in names if left[c]]
    if unsettled:
        raise RuntimeError(f"the search for a power transform of {unsettled} did not settle")
    return centre


def _filled(df: DataFrame, columns: Sequence[str], missing: Mapping[str, int]) -> dict[str, Column]:
    """Expression per column with missing cells replaced by the median, where there are any."""
    gaps = [c for c in columns if missing[c]]
    medians = exact_medians(df, gaps)
    return {c: F.coalesce(q(c).cast("double"), F.lit(medians[c])) if medians.get(c) is not None
            else q(c).cast("double") for c in columns}


def _minmax(low, high) -> dict:
    return {"kind": "minmax", "center": low, "scale": high - low}


def fit_scalers(df: DataFrame, columns: Sequence[str], strategy: str | None = "auto", ordinal: Sequence[str] = (),
                skew_with_missing: str = "minmax") -> dict[str, dict]:
    """Scaler per column; ``ordinal`` columns are always min-max scaled with missing as 0.

    ``auto`` chooses by skewness: power above 1, robust above 0.5, else min-max. A column with missing
    cells has no defined skewness and gets min-max; ``skew_with_missing="skip"`` leaves the gaps out
    instead. Statistics are taken after filling gaps with the median. All moments are one aggregate; only
    the columns that need quantiles or a lambda cost further passes.
    """
    if strategy not in SCALING_STRATEGIES:
        raise ValueError(f"unknown scaling strategy {strategy!r}")
    if strategy in ("none", None):
        return {}
    columns = [c for c in columns if c in df.columns]
    ordinal = [c for c in ordinal if c in df.columns]
    coded = {c: F.coalesce(q(c).cast("double"), F.lit(0.0)) for c in ordinal}
    wanted = {"auto": ("missing", "skew"), "standard": ("missing", "mean", "std"), "robust": ("missing",),
              "minmax": ()}[strategy]
    moments = fit_moments(df, [*columns, *[c for c in ordinal if c not in columns]], ("min", "max", *wanted), coded)

    kinds = {}
    for c in columns:
        skew = moments[c].get("skew")
        if strategy != "auto":
            kinds[c] = strategy
        elif skew is None or math.isnan(skew) or (moments[c]["missing"] and skew_with_missing == "minmax"):
            kinds[c] = "minmax"
        else:
            kinds[c] = "power" if abs(skew) > 1 else "robust" if abs(skew) > 0.5 else "minmax"

    missing = {c: moments[c].get("missing", 0) for c in columns}
    filled = _filled(df, [c for c in columns if kinds[c] != "minmax" and moments[c]["min"] is not None], missing)
    robust = [c for c in filled if kinds[c] == "robust"]
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in robust}, filled)
    power = {c: e for c, e in filled.items() if kinds[c] == "power"}
    lambdas = fit_yeo_johnson(df, power) if power else {}
    around = {c: yeo_johnson(filled[c], lambdas[c]) if c in lambdas else filled[c]
              for c in filled if kinds[c] in ("power", "standard") and (c in lambdas or missing[c])}
    refit = fit_moments(df, list(around), ("mean", "std"), around)

    scalers = {}
    for c in columns:
        m = moments[c]
        if m["min"] is None:
            continue
        if kinds[c] == "minmax":
            scalers[c] = _minmax(m["min"], m["max"])
        elif kinds[c] == "robust":
            low, mid, high = quartiles[c]
            scalers[c] = {"kind": "robust", "center": mid, "scale": high - low}
        else:
            m = refit.get(c, m)
            scalers[c] = {"kind": kinds[c], "center": m["mean"], "scale": m["std"]}
            if c in lambdas:
                scalers[c]["lambda"] = lambdas[c]
    for c in ordinal:
        if moments[c]["min"] is not None:
            scalers[c] = _minmax(moments[c]["min"], moments[c]["max"])
    return scalers
