"""Flatten and decode: raw record (codes) -> the 24-column school record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.functions import codes
from campuslens.schemas import API_FIELDS, FACT_COLUMNS, RECORD_COLUMNS, REPORTED


def flatten_record(records: DataFrame) -> DataFrame:
    """Rename the dotted API keys of unnested page records to plain columns.

    A NaN is a missing value and becomes null, so it ranks last like one.
    Dotted names are back-ticked once here and never referred to again.
    Extra columns (page ordinals) are kept after the record columns.
    """
    present = set(records.columns)

    def value(key, kind):
        c = F.col(f"`{key}`")
        return F.when(~F.isnan(c), c) if isinstance(kind, T.DoubleType) else c

    cols = [value(key, kind).alias(plain) for key, plain, kind in API_FIELDS if key in present]
    plain_keys = {key for key, _, _ in API_FIELDS}
    extras = [F.col(f"`{c}`") for c in records.columns if c not in plain_keys]
    return records.select(*cols, *extras)


def decode(raw: DataFrame) -> DataFrame:
    """Apply the five code tables; output is the 24-column school record."""
    return raw.select(
        *[F.col(c) for c in RECORD_COLUMNS[:4]],
        codes.decode_ownership(F.col("ownership")).alias("school_type"),
        *[F.col(c) for c in RECORD_COLUMNS[5:20]],
        codes.decode_program_name(F.col("carnegie_basic")).alias("program_name"),
        codes.decode_duration(F.col("level")).alias("duration"),
        codes.decode_program_type(F.col("carnegie_undergrad")).alias("program_type"),
        codes.research_tier(F.col("carnegie_basic")).alias("research_output"),
    )


def project_fact(df: DataFrame) -> DataFrame:
    """The 17 columns of the ``university`` fact table.

    The internal flag ``admission_reported`` follows where the rows have it.
    """
    return df.select(*FACT_COLUMNS, *[c for c in (REPORTED,) if c in df.columns])
