"""Range rules with a drop-or-null policy."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.numeric import out_of_range
from tablewright.operators.columns import q, replace_columns


def violations(df: DataFrame, rules: Mapping) -> dict:
    """Column name -> boolean expression that is true on a violation."""
    return {c: out_of_range(q(c), *bounds) for c, bounds in rules.items() if c in df.columns}


def any_violation(df: DataFrame, rules: Mapping):
    return reduce(lambda a, b: a | b, violations(df, rules).values(), F.lit(False))


def flag_ranges(df: DataFrame, rules: Mapping, suffix: str = "_bad") -> DataFrame:
    """Add one boolean column per rule."""
    return df.select("*", *[v.alias(c + suffix) for c, v in violations(df, rules).items()])


def null_out_of_range(df: DataFrame, rules: Mapping) -> DataFrame:
    """Offending cells become NULL."""
    return replace_columns(df, {c: F.when(~bad, q(c)) for c, bad in violations(df, rules).items()})


def enforce_ranges(df: DataFrame, rules: Mapping, max_drop_ratio: float = 0.05) -> DataFrame:
    """Delete the offending rows if they are few, otherwise keep them with the offending cells NULL.

    "Few" is 0 < bad rows / rows < ``max_drop_ratio``; a ratio equal to the limit keeps the rows. One
    aggregate finds the ratio; the result is then a plain filter or projection.
    """
    if not violations(df, rules):
        return df
    bad_row = any_violation(df, rules)
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad_row).alias("bad")).first()
    if counts["bad"] == 0:
        return df
    if counts["bad"] / counts["n"] < max_drop_ratio:
        return df.filter(~bad_row)
    return null_out_of_range(df, rules)
