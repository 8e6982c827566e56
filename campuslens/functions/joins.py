"""Size-checked broadcast joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Rows of a small side that may be broadcast (narrow rows: a few megabytes).
CHECKED_BOUND = 100_000


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows. Beyond the bound the frame
    is returned unhinted and the planner falls back to a shuffled join (with
    AQE skew splitting), so a dimension that outgrows its bound degrades to
    a slower plan instead of an executor out of memory.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def attach_id(df: DataFrame, dim: DataFrame, value_col: str, id_col: str,
              proven_bound: int | None = None, checked_bound: int = CHECKED_BOUND) -> DataFrame:
    """Left outer lookup of ``id_col`` by name.

    ``proven_bound``: the dimension's row bound is proven by construction
    (decoded labels of a code table), so it is broadcast without a check.
    Otherwise (a stored dimension of unknown provenance) it is counted first
    and broadcast only within ``checked_bound`` rows.
    """
    side = dim.select(value_col, id_col)
    side = F.broadcast(side) if proven_bound is not None else broadcast_if_bounded(side, checked_bound)
    return df.join(side, value_col, "left")
