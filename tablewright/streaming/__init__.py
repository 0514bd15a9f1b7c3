"""Streams.

A fitted ``TransformerModel`` and ``CleanerModel.standardise`` are stateless projections and apply to a
streaming DataFrame as they are. Duplicate removal, the drop-or-null decision and ordered fills look at the
whole table, so they are for batch tables only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablewright.operators.impute import fill_values
from tablewright.plans.cleaner import CleanerModel
from tablewright.plans.transformer import TransformerModel


def apply_row_wise(df: DataFrame, cleaner: CleanerModel, transformer: TransformerModel) -> DataFrame:
    """Standardise texts, fill missing values and transform each row with fitted models."""
    filled = fill_values(cleaner.standardise(df), cleaner.medians, cleaner.modes)
    return transformer.transform(filled)
