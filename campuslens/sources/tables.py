"""Table sinks in the shared folder: bucketed, partitioned, appended, staged and checked."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.session import MAX_BUCKETS, remove, scratch_path


def store_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``key``; return it read back.

    A later join or anti join on ``key`` reads the table co-partitioned: only
    the other side is shuffled, into the same ``buckets`` partitions (default
    ``spark.sql.shuffle.partitions``). The frame is repartitioned by ``key``
    first, so every task writes one file per bucket instead of one per
    bucket it happens to hold. The files live under the shared checkpoint
    folder; the table is registered in the session catalog.
    """
    spark = df.sparkSession
    buckets = min(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
    table_name = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key)
     .write.bucketBy(buckets, key).sortBy(key)
     .option("path", scratch_path(spark, name))
     .saveAsTable(table_name))
    return spark.table(table_name)


def append_rows(df: DataFrame, path: str) -> int:
    """Append ``df`` to the Parquet folder ``path``; return the rows written.

    The count is observed while writing, without a second pass.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]


def store_partitioned(df: DataFrame, column: str, name: str = "partitioned", tasks: int | None = None) -> DataFrame:
    """Write ``df`` laid out by ``column``, one folder a value; return it read back.

    For columns of few values (labels, dimension ids): a filter on the
    column, also one that a join only knows at run time, then reads the
    folders of its values alone. Rows are dealt by (value, hash of the row),
    so a value that holds a third of them is written by many tasks; rows of
    a value land in at most ``tasks`` files (default: a sixteenth of
    ``spark.sql.shuffle.partitions``).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    tasks = tasks or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(tasks))
    df.repartition(F.col(column), salt).write.partitionBy(column).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty_clone(spark: SparkSession, schema: T.StructType, name: str) -> str:
    """Create or replace the session view ``name``: an empty table of ``schema`` that takes inserts.

    The view lies on a fresh Parquet folder of the shared location, so what
    an earlier view of the name holds is out of sight at once. ``INSERT``
    checks against the schema: too few or too many columns, or a type that
    does not fit safely, is an error and adds nothing. (``BY NAME``, SQL
    takes an absent column as null; ``insert_rows`` does not.) Returns the
    folder.
    """
    path = scratch_path(spark, name)
    spark.createDataFrame([], schema).write.parquet(path)
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}` ({columns}) USING parquet OPTIONS (path '{path}')")
    return path


def insert_rows(df: DataFrame, name: str) -> None:
    """``INSERT INTO`` the view ``name``, columns matched by name; an absent or additional one is an error."""
    wanted = df.sparkSession.table(f"`{name}`").columns
    if sorted(wanted) != sorted(df.columns):
        raise ValueError(f"columns {df.columns} do not match those of {name}: {wanted}")
    df.sparkSession.sql(f"INSERT INTO `{name}` BY NAME SELECT * FROM {{rows}}", rows=df)


class RepeatedKey(ValueError):
    """A write met a key twice and was taken back."""


def marked_repeats(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """``flag``: whether a row is the second or a later one of its keys (a null key repeats nothing).

    A look at the row before, within the keys' sort: no row is buffered, so
    a key of a third of all rows needs no more memory than another. Rows of
    null keys are dealt by their content.
    """
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    spread = F.when(null, F.xxhash64(*df.columns))
    before = F.lag(F.lit(True)).over(Window.partitionBy(*keys, spread).orderBy(*keys))
    return df.withColumn(flag, before.isNotNull() & ~null)


def write_checked(df: DataFrame, path: str, *unique: list[str], mode: str = "errorifexists") -> int:
    """Write ``df`` to ``path`` in one pass that also checks its keys; return the rows written.

    ``unique`` are the key columns that must not repeat (the key of a fact;
    name and id, each on its own, of a dimension). The counts are observed by
    the writing job itself; if a key repeats, the folder is removed and
    ``RepeatedKey`` raised, so nothing of it can be committed.
    """
    seen, flags = Observation(), [f"_repeat_{i}" for i in range(len(unique))]
    rows = df
    for keys, flag in zip(unique, flags):
        rows = marked_repeats(rows, list(keys), flag)
    counts = [F.count_if(flag).alias(flag) for flag in flags]
    rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).drop(*flags).write.mode(mode).parquet(path)
    found = seen.get
    repeated = {", ".join(keys): found[flag] for keys, flag in zip(unique, flags) if found[flag]}
    if repeated:
        remove(df.sparkSession, path)
        raise RepeatedKey(f"taken back: repeated keys {repeated}")
    return found["rows"]
