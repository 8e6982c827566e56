"""Vector columns: which rows take part, and their values as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, key: str, column: str, allow_zero: bool, *more: Column) -> DataFrame:
    """(vec_id long, vec array<double>) of the rows that take part, and ``more`` of their columns.

    Left out: a null key, a null vector, a null or non-finite component and,
    unless ``allow_zero``, vectors of zeros only (or without components).
    """
    vec = F.col(column).cast("array<double>")
    good = (F.col(key).isNotNull() & vec.isNotNull()
            & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    if not allow_zero:
        good = good & F.exists(vec, lambda x: x != 0.0)
    return df.where(good).select(F.col(key).cast("long").alias("vec_id"), vec.alias("vec"), *more)


def arrays(column) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, lengths) of an Arrow list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunks at all
            return np.zeros(0), np.zeros(0, np.int64)
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def by_length(keys: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{length: (keys, matrix)}: vectors are only compared with their equals in length."""
    start = np.cumsum(lengths) - lengths
    out = {}
    for d in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == d)
        out[d] = (keys[own], flat[start[own][:, None] + np.arange(d)[None, :]])
    return out
