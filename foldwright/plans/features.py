"""From raw applications to the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.functions.dates import date_diff_days, months_between_years
from foldwright.operators.cleaning import (
    as_date,
    binary_label,
    bucketize_case,
    cast_int,
    cast_to_date,
    drop_null_subset,
    filter_range,
    has_values,
)
from foldwright.sources.applicants import APPROVED

# Names of the columns of the input and of the derived table.
REQUIRED = ["AGE", "APPLICANT_FAMILY_COUNT", "MARITAL_STATUS", "GENDER_DESC"]
DATES = ["APPLICATION_DATE", "APPROVED_DATE", "APPLICANT_BIRTH_DATE"]
NUMERIC = ["AGE_AT_APPLICATION", "APPLICANT_FAMILY_COUNT", "APPLICATION_YEAR"]
CATEGORICAL = ["MARITAL_STATUS", "GENDER_DESC"]
BUCKETED = ["AGE_GROUP", "FAMILY_SIZE_CATEGORY"]

# The bounds and names of the age groups and family sizes.
AGE_GROUPS = [
    ("<", 25, "Young (18-24)"),
    ("<", 35, "Young Adult (25-34)"),
    ("<", 45, "Middle Age (35-44)"),
    ("<", 55, "Mature (45-54)"),
    ("<", 65, "Senior (55-64)"),
]
OLDEST_GROUP = "Elderly (65+)"
FAMILY_SIZES = [
    ("==", 0, "No Dependents"),
    ("<=", 2, "Small (1-2)"),
    ("<=", 4, "Medium (3-4)"),
    ("<=", 6, "Large (5-6)"),
]
LARGEST_FAMILY = "Very Large (7+)"
AGE_LIMITS = (18, 100)


def clean(df: DataFrame) -> DataFrame:
    """Drop rows that lack a required column, make the dates dates, and drop ``AGE`` after its check."""
    kept = drop_null_subset(df, REQUIRED)
    return cast_int(cast_to_date(kept, DATES), "AGE").drop("AGE")


def age_at_application() -> Column:
    return months_between_years(F.col("APPLICATION_DATE"), F.col("APPLICANT_BIRTH_DATE"))


def derive_features(df: DataFrame, approved: str = APPROVED) -> DataFrame:
    """Add age, year, processing days, approval label and the two bucket columns to cleaned rows."""
    dated = df.withColumns(
        {
            "AGE_AT_APPLICATION": age_at_application(),
            "APPLICATION_YEAR": F.year("APPLICATION_DATE"),
            "PROCESSING_DAYS": date_diff_days(F.col("APPROVED_DATE"), F.col("APPLICATION_DATE")),
        }
    )
    labelled = binary_label(dated, "APPLICATION_STATUS_NAME", approved, "APPROVAL_LABEL")
    aged = bucketize_case(labelled, "AGE_AT_APPLICATION", AGE_GROUPS, OLDEST_GROUP, "AGE_GROUP")
    return bucketize_case(aged, "APPLICANT_FAMILY_COUNT", FAMILY_SIZES, LARGEST_FAMILY, "FAMILY_SIZE_CATEGORY")


def feature_table(df: DataFrame, approved: str = APPROVED) -> DataFrame:
    """Clean, derive, and keep the applicants of a valid age."""
    return filter_range(derive_features(clean(df), approved), "AGE_AT_APPLICATION", *AGE_LIMITS)


def feature_steps(df: DataFrame) -> dict[str, Column]:
    """The row filters of ``feature_table`` as conditions on the raw rows ``df``, for ``stage_counts``."""
    dated = months_between_years(as_date(df, "APPLICATION_DATE"), as_date(df, "APPLICANT_BIRTH_DATE"))
    valid = F.coalesce(dated.between(*AGE_LIMITS), F.lit(False))
    return {"loaded": F.lit(True), "complete": has_values(df, REQUIRED), "valid_age": valid}
