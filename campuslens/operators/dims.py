"""Dimension tables: distinct names, surrogate ids, insert-only upsert.

A dimension holds decoded labels, so its size is bounded by the label count
of its code table (plus the default label) no matter how large the fact
grows. That bound is what makes the single-partition ``row_number`` that
numbers it, and the broadcast that attaches it, safe at any scale; the
bound is checked before a stored dimension is broadcast.

Ids follow first occurrence in rank order. A stored id never changes: new
names continue from the stored maximum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.functions.ids import small_row_number

FIRST = "first_rank"


def first_occurrence(df: DataFrame, value_col: str, order_col: str = "rank") -> DataFrame:
    """Distinct values with their best position (``min`` of ``order_col``).

    A partial aggregate per input partition runs before the shuffle, so a
    label held by a third of all rows still ships one row per partition.
    """
    return df.groupBy(value_col).agg(F.min(order_col).alias(FIRST))


def drop_null_names(df: DataFrame, value_col: str) -> DataFrame:
    """Rows without a name make no dimension row."""
    return df.dropna(subset=[value_col])


def number_dim(firsts: DataFrame, value_col: str, id_col: str, start: int = 0) -> DataFrame:
    """Dense ids ``start+1..start+n`` in first-occurrence order."""
    return firsts.select(
        (small_row_number([F.col(FIRST)]) + F.lit(start)).cast("int").alias(id_col),
        value_col)


def build_dim(df: DataFrame, value_col: str, id_col: str, order_col: str = "rank") -> DataFrame:
    """Frame-local dimension: ids 1..n by first occurrence."""
    return number_dim(first_occurrence(drop_null_names(df, value_col), value_col, order_col), value_col, id_col)


def new_names(stored: DataFrame, df: DataFrame, value_col: str, order_col: str = "rank") -> DataFrame:
    """Names of ``df`` not yet in ``stored`` (set-based ``NOT EXISTS``)."""
    return first_occurrence(drop_null_names(df, value_col), value_col, order_col).join(
        stored.select(value_col), value_col, "left_anti")


def next_ids(stored: DataFrame, df: DataFrame, value_col: str, id_col: str,
             order_col: str = "rank") -> DataFrame:
    """Auto-increment ids for new names: stored maximum + first-occurrence order."""
    start = F.coalesce(stored.select(F.max(id_col)).scalar(), F.lit(0))
    fresh = new_names(stored, df, value_col, order_col)
    return fresh.select(
        (small_row_number([F.col(FIRST)]) + start).cast("int").alias(id_col),
        value_col)


def upsert_dim(stored: DataFrame, df: DataFrame, value_col: str, id_col: str,
               order_col: str = "rank") -> DataFrame:
    """Insert-only merge: stored rows unchanged, new names appended."""
    return (stored.select(id_col, value_col)
            .unionByName(next_ids(stored, df, value_col, id_col, order_col)))


def check_unique(dim: DataFrame, value_col: str, id_col: str, name: str) -> DataFrame:
    """One summary row: rows, distinct names and ids, and repeats of each.

    Per-name and per-id counts are stacked and summarised in one global
    aggregate, so no join is needed to put the two sides in one row.
    """
    kind = F.col("kind")
    per_name = dim.groupBy(value_col).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("name").alias("kind"), "n")
    per_id = dim.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("id").alias("kind"), "n")
    return per_name.unionByName(per_id).agg(
        F.lit(name).alias("dimension"),
        F.coalesce(F.sum(F.when(kind == "name", F.col("n"))), F.lit(0)).cast("long").alias("rows"),
        F.count_if(kind == "name").alias("distinct_names"),
        F.count_if((kind == "name") & (F.col("n") > 1)).alias("repeated_names"),
        F.count_if(kind == "id").alias("distinct_ids"),
        F.count_if((kind == "id") & (F.col("n") > 1)).alias("repeated_ids"))
