"""Dashboard column expressions: zero-as-missing measures, display text, bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslens.schemas import REPORTED

# ---------------------------------------------------------------------------
# Fixed values. "Highly Selective" at or below 10 % is documented; the other
# bounds and labels are this package's defaults (a parameter of
# ``selectivity_band``).
# ---------------------------------------------------------------------------
NOT_REPORTED = "Not Reported"
SELECTIVITY_BANDS = [
    (0.10, "Highly Selective"),
    (0.25, "Very Selective"),
    (0.50, "Selective"),
    (0.75, "Less Selective"),
]
ABOVE_BANDS = "Open"
# ---------------------------------------------------------------------------


def zero_as_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def avg_excluding_zero(c: Column) -> Column:
    """Average that skips zeros (stored stand-ins for missing); null if all are zero."""
    return F.avg(zero_as_null(c))


def rounded(c: Column, places: int = 6) -> Column:
    return F.round(c, places)


def display_whole(c: Column) -> Column:
    """Metric as whole-number text, or ``Not Reported`` for a stored zero."""
    return (F.when(c == 0, F.lit(NOT_REPORTED))
            .otherwise(F.round(c).cast("bigint").cast("string")))


def display_percent(c: Column) -> Column:
    """Rate as a whole percent text, or ``Not Reported`` for a stored zero."""
    return (F.when(c == 0, F.lit(NOT_REPORTED))
            .otherwise(F.concat(F.round(c * 100).cast("bigint").cast("string"), F.lit("%"))))


def reported_rate(fact: DataFrame) -> Column:
    """The admission rate as reported: null where it was missing or is a stored zero.

    Facts without the internal flag cannot tell a filled 1 from a true one.
    """
    rate = zero_as_null(F.col("admission_rate"))
    return F.when(F.col(REPORTED), rate) if REPORTED in fact.columns else rate


def selectivity_band(rate: Column, bands=SELECTIVITY_BANDS, above: str = ABOVE_BANDS) -> Column:
    """Band label of an admission rate; each bound is inclusive; null -> Not Reported."""
    expr = F.when(rate.isNull(), F.lit(NOT_REPORTED))
    for bound, label in bands:
        expr = expr.when(rate <= F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(above))
