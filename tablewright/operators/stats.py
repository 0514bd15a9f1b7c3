"""The fit side: aggregates that describe columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.numeric import nan_to_null, out_of_range
from tablewright.functions.text import category_text
from tablewright.operators.columns import q
from tablewright.operators.quantiles import exact_quantiles
from tablewright.operators.ranges import any_violation

def _long(df: DataFrame, names: Sequence[str], value="value") -> DataFrame:
    """One (column, value) row per text cell."""
    pairs = [F.struct(F.lit(c).alias("column"), q(c).cast("string").alias(value)) for c in names]
    return df.select(F.inline(F.array(*pairs)))


def value_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value, n) of the present values of several columns in one scan."""
    return (_long(df, names).filter(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def column_modes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value, n): the most frequent value per column, ties to the smallest.

    Counts are combined map-side per distinct value and the winner is a second, tiny aggregate, so no
    task holds all the values of a column as the built-in ``mode`` does.
    """
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("value").alias("value")))
    return (value_counts(df, names).groupBy("column").agg(best.alias("best"))
            .select("column", F.col("best.value").alias("value"), (-F.col("best.minus_n")).alias("n")))


def fit_modes(df: DataFrame, names: Sequence[str], empty: str = "Unknown") -> dict[str, str]:
    if not names:
        return {}
    found = {r["column"]: r["value"] for r in column_modes(df, names).collect()}
    return {c: found.get(c, empty) for c in names}


def category_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct (column, value) pairs of nominal columns; a missing value is the category ``nan``."""
    as_text = df.select(*[category_text(q(c)).alias(c) for c in names])
    return _long(as_text, names).distinct()


#: Categories of a column beyond which ``fit_categories`` refuses unless told otherwise.
MAX_CATEGORIES = 100_000


def fit_categories(df: DataFrame, names: Sequence[str], limit: int | None = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted categories per column, each of which becomes a column. More than ``limit`` in one column is an error that names it; None lifts the limit."""
    if not names:
        return {}
    values = category_values(df, names)
    # One more than all columns may have together: then some column has too many.
    rows = (values if limit is None else values.limit(limit * len(names) + 1)).collect()
    found = {c: sorted(r["value"] for r in rows if r["column"] == c) for c in names}
    large = sorted(c for c, v in found.items() if limit is not None and len(v) > limit)
    if large:
        raise ValueError(f"more than {limit} categories in {large}")
    return found


# Name -> aggregate of a double column. ``skewness`` is the population (biased) third moment.
MOMENTS = {
    "count": F.count,
    "missing": lambda c: F.count_if(c.isNull()),
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "std": F.stddev_pop,
    "skew": F.skewness,
}


def moment_aggregates(names: Sequence[str], stats: Sequence[str], exprs=None) -> list:
    exprs = exprs or {}
    return [MOMENTS[s](nan_to_null(exprs.get(c, q(c)).cast("double"))).alias(f"{s}:{c}")
            for c in names for s in stats]


def fit_moments(df: DataFrame, names: Sequence[str], stats: Sequence[str] = tuple(MOMENTS), exprs=None) -> dict:
    """{column: {stat: value}}, all of it one aggregate."""
    if not names:
        return {}
    row = df.agg(*moment_aggregates(names, stats, exprs)).first()
    return {c: {s: row[f"{s}:{c}"] for s in stats} for c in names}


def describe(df: DataFrame, names: Sequence[str], stats: Sequence[str] = tuple(MOMENTS)) -> DataFrame:
    """The moments in long form (column, stat, value); one aggregate, then one row unfolded."""
    one = df.agg(*moment_aggregates(names, stats))
    cells = [F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"),
                      q(f"{s}:{c}").cast("double").alias("value")) for c in names for s in stats]
    return one.select(F.inline(F.array(*cells)))


def quantile_table(df: DataFrame, probs: Mapping[str, Sequence[float]]) -> DataFrame:
    """(column, prob, value) of exact quantiles."""
    found = exact_quantiles(df, probs)
    rows = [(c, float(p), v) for c, ps in probs.items() for p, v in zip(ps, found[c])]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")


def fit_bin_edges(df: DataFrame, names: Sequence[str], n_bins: int = 5, min_width: float = 1e-8) -> dict:
    """Quantile bin edges per column; edges closer than ``min_width`` are merged."""
    return merge_edges(exact_quantiles(df, edge_probs(names, n_bins)), min_width)


def edge_probs(names: Sequence[str], n_bins: int) -> dict[str, list[float]]:
    return {c: [i / n_bins for i in range(n_bins + 1)] for c in names}


def merge_edges(found: Mapping[str, Sequence], min_width: float = 1e-8) -> dict[str, list[float]]:
    """Edges closer than ``min_width`` to the one before are left out."""
    edges = {}
    for c, values in found.items():
        kept = [v for v in values[:1] if v is not None]
        kept += [b for a, b in zip(values, values[1:]) if b is not None and b - a > min_width]
        edges[c] = kept
    return edges


def audit(df: DataFrame, rules: Mapping, numeric: Sequence[str], caps: Mapping | None = None,
          drop: Sequence[str] = ()) -> DataFrame:
    """Data-quality counters (step, column, n) in one aggregate.

    Rows before and after removing duplicates, negative numbers, range violations per column, rows with
    any violation and cells outside the capping limits.
    """
    kept = df.drop(*drop)
    numeric = [c for c in numeric if c in kept.columns]
    after_abs = {c: F.abs(q(c)) if c in numeric else q(c) for c in kept.columns}
    checked = kept.select("*", *[after_abs[c].alias(f"abs:{c}") for c in rules if c in kept.columns])
    abs_rules = {f"abs:{c}": bounds for c, bounds in rules.items() if c in kept.columns}
    counters = [("rows", None, F.count(F.lit(1))),
                ("distinct_rows", None, F.count_distinct(F.struct(*[q(c) for c in kept.columns])))]
    counters += [("negative", c, F.count_if(q(c) < 0)) for c in numeric]
    counters += [("violation", c.removeprefix("abs:"), F.count_if(out_of_range(q(c), *bounds)))
                 for c, bounds in abs_rules.items()]
    counters.append(("bad_rows", None, F.count_if(any_violation(checked, abs_rules))))
    counters += [("capped", c, F.count_if((q(c) < low) | (q(c) > high))) for c, (low, high) in (caps or {}).items()]
    row = checked.agg(*[e.alias(f"k{i}") for i, (_, _, e) in enumerate(counters)])
    cells = [F.struct(F.lit(step).alias("step"), F.lit(c).cast("string").alias("column"),
                      F.col(f"k{i}").cast("bigint").alias("n")) for i, (step, c, _) in enumerate(counters)]
    return row.select(F.inline(F.array(*cells)))
