"""Numeric expressions: coercion, ranges, clipping, log and power transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def coerce_number(c: Column) -> Column:
    """Text to double; what is not a number becomes NULL, and so does NaN."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def out_of_range(c: Column, low=None, high=None) -> Column:
    """True where the number is below ``low`` or above ``high``; bounds are valid, missing is never out."""
    x = coerce_number(c)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (x < float(low))
    if high is not None:
        bad = bad | (x > float(high))
    return F.coalesce(bad, F.lit(False))


def clip(c: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; NULL stays NULL (``least`` and ``greatest`` alone would skip it)."""
    return F.when(c.isNotNull(), F.greatest(F.least(c.cast("double"), F.lit(high)), F.lit(low)))


def log_positive(c: Column) -> Column:
    """ln(1 + x) for positive numbers, everything else unchanged."""
    x = c.cast("double")
    return F.when(x > 0, F.log1p(x)).otherwise(x)


def yeo_johnson(c: Column, lam: float) -> Column:
    """Yeo-Johnson power transform (Yeo and Johnson, 2000) for a fixed lambda."""
    x = c.cast("double")
    if abs(lam) < 1e-12:
        upper = F.log1p(x)
    else:
        upper = (F.pow(x + 1.0, F.lit(lam)) - 1.0) / lam
    if abs(lam - 2.0) < 1e-12:
        lower = -F.log1p(-x)
    else:
        lower = -(F.pow(1.0 - x, F.lit(2.0 - lam)) - 1.0) / (2.0 - lam)
    return F.when(x >= 0, upper).otherwise(lower)


def bin_index(c: Column, interior_edges) -> Column:
    """Number of interior edges that are <= x, as double; NULL stays NULL."""
    index = F.lit(0.0)
    for edge in interior_edges:
        index = index + F.when(c >= float(edge), 1.0).otherwise(0.0)
    return F.when(c.isNotNull(), index)


def divide(c: Column, by: float) -> Column:
    """c / by, where a zero divisor counts as one."""
    return c / F.lit(by if by else 1.0)
