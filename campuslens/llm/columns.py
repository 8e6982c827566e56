"""Keeping a table's other columns out of an operator's way."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_aside(df: DataFrame, keep: Collection[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with every column not in ``keep`` under a plain name, and the way back.

    No name of the table can then clash with one that the operator makes;
    the way back gives the table's own columns, names and types (and no
    others).
    """
    fields = df.schema.fields
    plain = [f.name if f.name in keep else f"x{i}" for i, f in enumerate(fields)]

    def back(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(p).cast(f.dataType).alias(p) for p, f in zip(plain, fields)]).toDF(
            *[f.name for f in fields])

    return df.toDF(*plain), back
