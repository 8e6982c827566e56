"""Nine-key school ranking, top-k cut, rank numbers, re-sorting.

The cut uses ``orderBy(...).limit(k)``, which plans as
``TakeOrderedAndProject``: every partition keeps its own best k rows and
only those are merged, so the full table is never sorted or moved to one
task. Rank numbers are assigned after the cut, on at most k rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslens.functions.ids import global_position, small_row_number

# ---------------------------------------------------------------------------
# The ranking rule. Keys in priority order with direction;
# missing values sort last on every key. ``school_id`` is appended as the
# final tie-break so equal rows always get the same rank.
# ---------------------------------------------------------------------------
RANK_KEYS = [
    ("research_output", "asc"),
    ("admission_rate", "asc"),
    ("graduation_rate", "desc"),
    ("earnings_after_10yrs", "desc"),
    ("faculty_quality", "asc"),
    ("international_outlook", "desc"),
    ("revenue_per_student", "desc"),
    ("spending_per_student", "desc"),
    ("endowment", "desc"),
]
TOP_K = 1000
TIE_BREAK = "school_id"
# ---------------------------------------------------------------------------

# Rows that one task may number by a window.
ONE_TASK_ROWS = 100_000


def _sort_col(name: str, direction: str) -> Column:
    c = F.col(name)
    return c.asc_nulls_last() if direction == "asc" else c.desc_nulls_last()


def rank_order(keys=RANK_KEYS, tie_break: str = TIE_BREAK) -> list[Column]:
    """Sort expressions of the ranking, nulls last on every key."""
    return [_sort_col(n, d) for n, d in keys] + [F.col(tie_break).asc()]


def rank_key(keys=RANK_KEYS, tie_break: str = TIE_BREAK) -> Column:
    """One orderable struct whose ``min`` is a group's best row in rank order.

    Each key contributes ``(is_null, value)`` ascending, or
    ``(is_null, -value)`` for a descending numeric key, so struct comparison
    reproduces the nulls-last, mixed-direction order. This lets a groupBy
    find "first occurrence in rank order" with a partial aggregate instead
    of a global sort.
    """
    fields = []
    for i, (name, direction) in enumerate(keys):
        c = F.col(name)
        fields.append(c.isNull().alias(f"k{i}_null"))
        fields.append((c if direction == "asc" else -c).alias(f"k{i}"))
    fields.append(F.col(tie_break).alias("k_tie"))
    return F.struct(*fields)


def rank_sort(df: DataFrame, name: str = "sort_pos") -> DataFrame:
    """Every row with its 1-based position in rank order (distributed).

    Rows come back in no particular order; ``sort_pos`` is the order.
    """
    return global_position(df, rank_order(), name)


def top_k(df: DataFrame, k: int = TOP_K) -> DataFrame:
    """The best k rows in rank order (no rank column)."""
    return df.orderBy(*rank_order()).limit(k)


def ranked_top_k(df: DataFrame, k: int = TOP_K, name: str = "rank") -> DataFrame:
    """Best k rows with their 1-based rank.

    Up to ``ONE_TASK_ROWS`` rows are numbered in one task; more get
    distributed positions, with the same result.
    """
    best = top_k(df, k)
    if k > ONE_TASK_ROWS:
        return global_position(best, rank_order(), name).withColumn(name, F.col(name).cast("int"))
    return best.withColumn(name, small_row_number(rank_order()))


def resort(ranked: DataFrame, column: str, descending: bool = True,
           name: str = "position", tie_break: str = TIE_BREAK, k: int = TOP_K) -> DataFrame:
    """Re-sort a ranking table of at most ``k`` rows by a chosen column."""
    c = F.col(column)
    order = [c.desc_nulls_last() if descending else c.asc_nulls_last(), F.col(tie_break).asc()]
    if k > ONE_TASK_ROWS:
        return global_position(ranked, order, name).withColumn(name, F.col(name).cast("int"))
    return ranked.withColumn(name, small_row_number(order))
