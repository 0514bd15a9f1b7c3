"""Removal of duplicate rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.columns import q


def drop_duplicate_rows(df: DataFrame, row_key: str | None = None) -> DataFrame:
    """Keep one of each group of equal rows; missing equals missing.

    With ``row_key`` the key column is left out of the comparison and the smallest key of each group
    survives, so the result still has a unique key to split and match by. Both forms are aggregates
    with a map-side combine: copies of a row collapse before the shuffle, however many there are.
    """
    if row_key is None:
        return df.dropDuplicates()
    compared = [c for c in df.columns if c != row_key]
    found = df.groupBy(*[q(c) for c in compared]).agg(F.min(q(row_key)).alias(row_key))
    return found.select(*[q(c) for c in df.columns])
