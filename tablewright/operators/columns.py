"""Column lists and row-wise projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.numeric import coerce_number


def q(name: str):
    """Column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_integral(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.IntegralType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Integer, float and decimal columns, without booleans and without ``exclude``."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the listed columns; absent names are skipped."""
    return df.drop(*names)


def require(df: DataFrame, names: Sequence[str], what: str = "columns") -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"{what} not in the table: {absent}")


def split_target(df: DataFrame, target_col: str, drop: Sequence[str] = ("ID",)) -> tuple[list[str], str]:
    """Feature column names and the target; a table without the target is an error."""
    require(df, [target_col], "target")
    return [c for c in df.columns if c != target_col and c not in drop], target_col


def replace_columns(df: DataFrame, changes: dict) -> DataFrame:
    """One projection that replaces the given columns in place, keeps the order and appends new ones."""
    return df.withColumns(changes) if changes else df


def absolute(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Absolute value of the numeric columns."""
    names = numeric_columns(df) if names is None else [c for c in names if c in df.columns]
    return replace_columns(df, {c: F.abs(q(c)) for c in names})


def row_sum(df: DataFrame, names: Sequence[str], out: str) -> DataFrame:
    """Add ``out`` = sum of the columns as numbers, missing as 0; unchanged if a column is absent."""
    if any(c not in df.columns for c in names):
        return df
    total = F.lit(0.0)
    for c in names:
        total = total + F.coalesce(coerce_number(q(c)), F.lit(0.0))
    return replace_columns(df, {out: total})
