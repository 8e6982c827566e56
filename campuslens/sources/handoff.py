"""Text hand-off between stages: a typed frame as JSON lines, and back exactly.

A stage that cannot pass Parquet on (another runtime, a message store) writes
its frame as text. Every row is one JSON line with every column by its name,
nulls written out; doubles are in their shortest exact form, NaN and the
infinities by name, timestamps with microseconds, binary as base64. The
schema travels beside the rows and is written last, so a hand-off that broke
off is not read.

``read_text`` gives the frame back value for value and fails on text that is
not exactly what ``write_text`` would have written: cut off or garbled lines,
absent, repeated or additional keys, values of another type, anything after a
line's object. ``read_variant`` reads the same lines without a schema, as
VARIANT values from which ``field`` takes single keys, dotted ones included.

Defined cases: an empty frame is a hand-off without rows; columns whose names
contain dots or backticks keep them; two columns of one name are an error.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TIMESTAMP_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
WRITE = {"ignoreNullFields": "false", "timestampFormat": TIMESTAMP, "timestampNTZFormat": TIMESTAMP_NTZ}
READ = {"mode": "FAILFAST", "timestampFormat": TIMESTAMP, "timestampNTZFormat": TIMESTAMP_NTZ}


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def encode(df: DataFrame) -> DataFrame:
    """One JSON line (``value``) a row."""
    if len(set(df.columns)) < len(df.columns):
        raise ValueError("a text hand-off needs different column names")
    return df.select(F.to_json(F.struct(*[quoted(c) for c in df.columns]), WRITE).alias("value"))


def decode(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame of encoded lines; a line that does not encode to itself again is an error."""
    rows = lines.select("value", F.from_json("value", schema, READ).alias("row"))
    same = F.to_json("row", WRITE) == F.col("value")
    # a condition, not a column: it is evaluated whatever is selected afterwards
    sound = F.when(F.coalesce(same, F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("malformed hand-off line: "), F.coalesce(F.substring("value", 1, 200), F.lit("null"))))
        .cast("boolean"))
    return rows.where(sound).select(*[F.col("row").getField(f.name).alias(f.name) for f in schema.fields])


def write_text(df: DataFrame, path: str) -> str:
    encode(df).write.text(f"{path}/rows")
    df.sparkSession.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.text(f"{path}/schema")
    return path


def read_text(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()["value"]))
    return decode(spark.read.text(f"{path}/rows"), schema)


def read_variant(spark: SparkSession, path: str) -> DataFrame:
    """The lines as one VARIANT column ``record``; text that is no JSON, or repeats a key, fails."""
    return spark.read.text(f"{path}/rows").select(F.parse_json("value").alias("record"))


def field(record: Column | str, key: str, kind: str) -> Column:
    """The value of a key (dots and all) of a VARIANT object; a value of another type is an error."""
    path = '$["' + key.replace("\\", "\\\\").replace('"', '\\"') + '"]'
    return F.variant_get(F.col(record) if isinstance(record, str) else record, path, kind)
