"""Missing-value fills applied after the top-k cut.

The order matters: filling before the sort would move a null
``faculty_quality`` from last place to first. A bare ``fillna(0)`` skips
string columns, so the price-calculator link is filled with the string "0"
explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.schemas import REPORTED

# ---------------------------------------------------------------------------
# Columns filled with 0 after the cut, and the fill of the
# admission rate.
# ---------------------------------------------------------------------------
ZERO_FILL_COLUMNS = [
    "price_calculator", "in_state_tuition", "out_of_state_tuition",
    "average_sat_score", "earnings_after_10yrs", "graduation_rate",
    "international_outlook", "revenue_per_student", "spending_per_student",
    "endowment", "retention_rate", "financial_aid_percent", "faculty_quality",
]
ADMISSION_RATE_FILL = 1.0
# ---------------------------------------------------------------------------


def fill_zero(df: DataFrame) -> DataFrame:
    """Missing -> 0 on the 12 metric columns, "0" on the calculator link."""
    values = {c: 0.0 for c in ZERO_FILL_COLUMNS if c != "price_calculator"}
    values["price_calculator"] = "0"
    return df.fillna(values)


def fill_admission_rate(df: DataFrame) -> DataFrame:
    return df.fillna({"admission_rate": ADMISSION_RATE_FILL})


def cast_price_calculator(df: DataFrame) -> DataFrame:
    return df.withColumn("price_calculator", F.col("price_calculator").cast("string"))


def fill_missing(df: DataFrame) -> DataFrame:
    """All three steps in the order the load applies them."""
    return cast_price_calculator(fill_admission_rate(fill_zero(df)))


def flag_reported(df: DataFrame) -> DataFrame:
    """Keep, before the fills, whether the admission rate was reported."""
    return df.withColumn(REPORTED, F.col("admission_rate").isNotNull())
