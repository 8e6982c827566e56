"""Positional numbering without funnelling a large frame through one task.

``row_number()`` over an unpartitioned window moves every row into a single
partition. That is fine after a ``limit`` (at most k rows) or on a
dimension bounded by its code table, and wrong anywhere else. For a large
frame, ``global_position`` numbers rows in a total sort order the way a
distributed zip-with-index does: sort (range partitioned), tag each row with
``monotonically_increasing_id`` (partition index in the upper bits, row
index within the partition in the lower 33 bits), count rows per partition,
turn the counts into offsets, and add. The offsets table has one row per
partition, so its broadcast is bounded by the partition count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslens.session import stage

_LOW_BITS = (1 << 33) - 1


def global_position(df: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    """Append a 1-based position in ``order``, which must be a total order.

    The sorted, tagged frame is staged once in the shared folder: the ids
    depend on the physical partitioning, and two evaluations of the sort
    (one for the counts, one for the rows) are not guaranteed to partition
    alike. Counts, offsets and positions all come from the one copy.
    """
    tagged = stage(df.orderBy(*order)
                   .withColumn("_mid", F.monotonically_increasing_id())
                   .withColumn("_part", F.shiftright(F.col("_mid"), 33)), "positions")
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"))
    return (tagged.join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)) + 1)
                        .cast("long"))
            .drop("_mid", "_part", "_offset"))


def small_row_number(order: list[Column]) -> Column:
    """``row_number()`` over a global order; only for frames of bounded size."""
    return F.row_number().over(Window.orderBy(*order))
