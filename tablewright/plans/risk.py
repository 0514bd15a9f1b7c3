"""The configuration of the driver-risk table: 18 raw columns, target OUTCOME."""

from __future__ import annotations

from tablewright.plans.automl import AutoMLConfig
from tablewright.plans.cleaner import CleanerConfig
from tablewright.plans.prepare import PrepareConfig
from tablewright.plans.transformer import TransformerConfig

# Valid categories, ranges, treatments and orders of the risk table.
GOLDEN = {
    "GENDER": ["male", "female"],
    "EDUCATION": ["none", "high school", "university"],
    "INCOME": ["poverty", "working class", "middle class", "upper class"],
    "DRIVING_EXPERIENCE": ["0-9y", "10-19y", "20-29y", "30y+"],
    "VEHICLE_YEAR": ["before 2015", "after 2015"],
    "TYPE_OF_VEHICLE": ["sedan", "sports car", "suv", "hatchback"],
    "AGE": ["16-25", "26-39", "40-64", "65+"],
}
RANGES = {
    "CREDIT_SCORE": (0.0, 1.0),
    "VEHICLE_OWNERSHIP": (0, 1),
    "MARRIED": (0, 1),
    "CHILDREN": (0, 1),
    "ANNUAL_MILEAGE": (0, None),
    "PAST_ACCIDENTS": (0, None),
}
DROPPED = ["ID", "POSTAL_CODE", "DUIS", "SPEEDING_VIOLATIONS"]
OUTLIERS = {
    "ANNUAL_MILEAGE": "log",
    "PAST_ACCIDENTS": "log",
    "CREDIT_SCORE": "capping",
    "CHILDREN": None,
    "MARRIED": None,
    "VEHICLE_OWNERSHIP": None,
    "FAMILY_STABILITY": "log",
}
ORDINAL = {
    "AGE": {"16-25": 0, "26-39": 1, "40-64": 2, "65+": 3},
    "DRIVING_EXPERIENCE": {"0-9y": 0, "10-19y": 1, "20-29y": 2, "30y+": 3},
    "EDUCATION": {"none": 0, "high school": 1, "university": 2},
    "INCOME": {"poverty": 0, "working class": 1, "middle class": 2, "upper class": 3},
    "VEHICLE_YEAR": {"before 2015": 0, "after 2015": 1},
    "GENDER": {"female": 0, "male": 1},
}
FAMILY = ("MARRIED", "CHILDREN", "VEHICLE_OWNERSHIP")
TARGET = "OUTCOME"


def risk_cleaner(**changes) -> CleanerConfig:
    settings = {"golden_specs": GOLDEN, "range_rules": RANGES, "cols_to_drop": DROPPED, **changes}
    return CleanerConfig(**settings)


def risk_transformer(**changes) -> TransformerConfig:
    settings = {"scaling_strategy": "minmax", "outlier_strategies": OUTLIERS, "ordinal_mappings": ORDINAL,
                "nominal_cols": ["TYPE_OF_VEHICLE"], "ignore_cols": [TARGET], **changes}
    return TransformerConfig(**settings)


def risk_prepare(**changes) -> PrepareConfig:
    settings = {"cleaner": risk_cleaner(), "transformer": risk_transformer(),
                "sums": {"FAMILY_STABILITY": FAMILY}, "target_col": TARGET, "key": "ID", **changes}
    return PrepareConfig(**settings)


def risk_automl(**changes) -> AutoMLConfig:
    return AutoMLConfig(**{"target_col": TARGET, **changes})
