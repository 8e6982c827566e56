"""The latest record of every school across stream batches, by keyed state.

A page may be delivered again in a later batch, or late: an older run after
a newer one. For every school the stream's state store keeps the newest
record by its place (partition levels, page, position) with the time of the
batch that brought it; a record passes only if its place is beyond the one
held, so an older one can never win over a newer one, however many batches
lie between. Within a batch only the newest record of a school passes.

This is one streaming aggregate: ``max_by`` over the place, in the engine,
so a school costs no call into Python. Of equal places the one that came
first stays, and what this batch did not bring is not given on. (The batch
time is the stream's own, logged with its offsets: a replayed batch has the
same.)

The state is one record a school, in the RocksDB store (on executors'
disks, with its changes and snapshots in the shared checkpoint folder), so
it is bounded by disk, not memory, and survives lost executors. Rows of a
key are streamed through, never gathered. Records of null keys have no
identity: all of them pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_records(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The records of a stream that are newer than all before them with their key.

    The stream is to be written in update mode.
    """
    records.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    others = [c for c in records.columns if c != key]
    keyed = records.where(F.col(key).isNotNull()).withColumn("_came", F.current_timestamp())
    place = F.struct(*order, (-F.unix_micros("_came")).alias("_first"))  # nulls come first, as in a sort of the engine
    held = keyed.groupBy(key).agg(F.max_by(F.struct(*others, "_came"), place).alias("_row"))
    newest = held.where(F.col("_row._came") == F.current_timestamp()).select(key, "_row.*").select(*records.columns)
    return newest.unionByName(records.where(F.col(key).isNull()))
