"""Incremental ingest: newly landed pages -> top-k -> dimension and fact upsert.

A file stream over the landing root picks up only pages it has not seen
(the stream checkpoint records them). ``trigger(availableNow=True)``
processes what is there and stops, which matches a scheduled weekly run.

A load stores what it changed, not what there was: the rows of its top-k go
to a Parquet folder of their own,
``<root>/university/version=<n>/kind=delta/stream=<query id>/batch=<id>``,
beside the dimensions as of this load (bounded by their labels, so written
whole). Spark marks a finished folder with ``_SUCCESS``; the fact's folder is
written last, so its mark is the commit, and a load is there as a whole or
not at all. Readers take the stored base without the keys of the later
deltas (an anti join on their few keys), and of every such key its last row.
When the deltas have grown against the base, or are many, ``fold`` writes
their union as a new base; nothing is overwritten in place.

A batch replayed after a failure finds its (query id, batch id) among the
finished loads and is skipped; if it is not there, it writes its own folders
again. A new stream over old state, whose batch ids start at 0 again, has
another query id, so its data is loaded. Loads of one state run one after
another. ``expire`` deletes what only older reads need.
"""

from __future__ import annotations

import threading
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from campuslens.functions.joins import CHECKED_BOUND
from campuslens.operators.decode import decode, flatten_record
from campuslens.operators.rank import TOP_K
from campuslens.operators.upsert import assert_no_repeats, latest_per_key, upsert
from campuslens.plans import load as L
from campuslens.sources.api import stream_pages
from campuslens.sources.pages import unnest_pages
from campuslens.sources.tables import write_checked
from campuslens.schemas import (API_FIELDS, DIM_PROGRAM_SCHEMA, DIM_PROGRAM_TYPE_SCHEMA,
                                STORED_FACT_SCHEMA, page_schema)
from campuslens.session import remove, scratch_path, stage

TABLES = ("university", "dim_program", "dim_program_type")
# Deltas are folded into the base when they have this share of its bytes, or are so many.
FOLD_SHARE = 0.25
FOLD_DELTAS = 32
KEEP = 5


def landing_schema(levels: list[str]) -> T.StructType:
    """Landed page lines plus the partition levels of the landing layout."""
    fields = list(page_schema(with_page=True).fields)
    fields += [T.StructField(c, T.StringType(), True) for c in levels]
    return T.StructType(fields)


class Load(NamedTuple):
    """One finished folder of the fact; a base of a version holds all rows up to it."""

    version: int
    kind: str
    stream: str
    batch: str

    @property
    def folder(self) -> str:
        return f"version={self.version}/kind={self.kind}/stream={self.stream}/batch={self.batch}"


class StoredTables:
    """The fact and its dimensions under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas = {"university": STORED_FACT_SCHEMA, "dim_program": DIM_PROGRAM_SCHEMA,
                        "dim_program_type": DIM_PROGRAM_TYPE_SCHEMA}

    def _path(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def loads(self) -> list[Load]:
        """All finished loads and folds in order: one entry a load, from one listing."""
        pattern, fs = self._path(f"{self.root}/university/version=*/kind=*/stream=*/batch=*/_SUCCESS")
        found = []
        for status in fs.globStatus(pattern) or []:
            levels = status.getPath().getParent().toString().split("/")[-4:]
            version, kind, stream, batch = (level.split("=", 1)[1] for level in levels)
            found.append(Load(int(version), kind, stream, batch))
        return sorted(found, key=lambda x: (x.version, x.kind == "base", x.stream, x.batch))

    def committed(self) -> list[int]:
        return sorted({x.version for x in self.loads()})

    def _read(self, name: str, loads: list[Load], more: T.StructType | None = None) -> DataFrame:
        schema = self.schemas[name] if more is None else T.StructType([*self.schemas[name].fields, *more.fields])
        if not loads:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
                .parquet(*[f"{self.root}/{name}/{x.folder}" for x in loads]).select(*schema.names))

    def _split(self, loads: list[Load]) -> tuple[list[Load], list[Load]]:
        """The last base and the deltas after it."""
        base = [x for x in loads if x.kind == "base"][-1:]
        return base, [x for x in loads if x.kind == "delta" and (not base or x.version > base[0].version)]

    def current(self, name: str, loads: list[Load] | None = None) -> DataFrame:
        """The table as of the last finished load."""
        loads = self.loads() if loads is None else loads
        if name != "university":
            return self._read(name, [x._replace(kind="delta") for x in loads[-1:]])  # a fold has those of its load
        base, deltas = self._split(loads)
        columns = [f.name for f in self.schemas[name].fields]
        if len(deltas) <= 1 and not base:
            return self._read(name, deltas)
        order = T.StructType([T.StructField("version", T.LongType()), T.StructField("stream", T.StringType())])
        changed = latest_per_key(self._read(name, deltas, order), "school_id", ["version", "stream"]).select(*columns)
        if not base:
            return changed
        bound = changed.limit(CHECKED_BOUND + 1).count() if deltas else 0
        return upsert(self._read(name, base), changed, "school_id", source_rows_bound=bound)

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose the current tables to SQL as temporary views.

        Dashboard users can then keep writing SQL
        (``spark.sql("SELECT ... FROM university JOIN dim_program ...")``)
        against the same state the DataFrame functions read.
        """
        loads = self.loads()
        for name in TABLES:
            self.current(name, loads).createOrReplaceTempView(prefix + name)
        return [prefix + name for name in TABLES]

    def write(self, load: Load, name: str, df: DataFrame) -> DataFrame:
        """Write one table's folder of a load and return it read back.

        A dimension's ids and names are checked by the job that writes it: a
        repeat takes the folder back, and the load ends before its fact.
        """
        path = f"{self.root}/{name}/{load.folder}"
        if name == "university":
            df.write.mode("overwrite").parquet(path)
        else:
            write_checked(df, path, *[[f.name] for f in self.schemas[name].fields], mode="overwrite")
        return self.spark.read.schema(self.schemas[name]).parquet(path)

    def _bytes(self, loads: list[Load]) -> int:
        total = 0
        for x in loads:
            path, fs = self._path(f"{self.root}/university/{x.folder}")
            total += fs.getContentSummary(path).getLength()
        return total

    def fold(self, force: bool = False) -> bool:
        """Write base and deltas as a new base, if the deltas have grown; whether it did."""
        loads = self.loads()
        base, deltas = self._split(loads)
        held, later = (base, deltas) if base else (deltas[:1], deltas[1:])  # a first delta is as good as a base
        due = len(later) > FOLD_DELTAS or (bool(later) and self._bytes(later) >= FOLD_SHARE * self._bytes(held))
        if not deltas or not (force or due):
            return False
        last = deltas[-1]
        self.write(Load(last.version, "base", last.stream, last.batch), "university", self.current("university", loads))
        return True

    def expire(self, keep: int = KEEP) -> int:
        """Delete folders that reads as of the last ``keep`` loads do not need; return their number.

        Readers of older states must be done.
        """
        loads = self.loads()
        versions = sorted({x.version for x in loads})
        first = versions[-keep:][0] if versions else 0
        base = max((x.version for x in loads if x.kind == "base" and x.version <= first), default=-1)
        gone = [f"university/{x.folder}" for x in loads
                if x.version < base or (x.version == base and x.kind == "delta")]
        gone += [f"{name}/{x.folder}" for x in loads if x.kind == "delta" and x.version < first for name in TABLES[1:]]
        for folder in gone:
            path, fs = self._path(f"{self.root}/{folder}")
            fs.delete(path, True)
        return len(gone)


def process_batch(tables: StoredTables, batch: DataFrame, batch_id: int, query_id: str,
                  k: int = TOP_K, on_repeat: str = "raise") -> None:
    """Rank, cut, fill and load one batch of landed pages.

    A batch may hold several runs (a week was missed): a school in more than
    one of them keeps the record of the latest run, in the order of the
    partition levels. A school twice within one run is an error
    (``on_repeat="raise"``), or keeps its latest record by (page, position)
    (``"latest"``). This is decided before ranking, so a repeat can never
    take two top-k places.
    """
    levels = [c for c in batch.columns if c not in ("page", "start", "results")]
    load_records(tables, flatten_record(unnest_pages(batch)), levels, batch_id, query_id, k, on_repeat)


def load_records(tables: StoredTables, records: DataFrame, levels: list[str], batch_id: int, query_id: str,
                 k: int = TOP_K, on_repeat: str = "raise") -> None:
    """Rank, cut, fill and load raw records (partition levels, page, pos) as one load.

    Repeats are observed by the job that writes the top-k: a batch that has
    some is given up before anything of it is stored.
    """
    loads = tables.loads()
    if any((x.stream, x.batch) == (query_id, str(batch_id)) for x in loads):
        return
    load = Load(loads[-1].version + 1 if loads else 0, "delta", query_id, str(batch_id))
    # The top-k (at most k rows) is read by several steps: staged in the
    # shared folder, it is computed once and survives the loss of an
    # executor. It goes when the batch is stored.
    scratch = scratch_path(tables.spark, "batch")
    repeats = Observation()
    latest = latest_per_key(records, "school_id", [*levels, "page", "pos"], levels, repeats)
    top_df = stage(L.transform(decode(latest.drop(*levels)), k, flag=True), path=f"{scratch}/top")
    if on_repeat != "latest":
        try:
            assert_no_repeats(repeats, "school_id")
        except ValueError:
            remove(tables.spark, scratch)
            raise
    # Dimensions are written first; the fact rows take their ids from the
    # stored versions (the same flow as a batch load).
    rows, _, _ = L.stage_load(*[tables.current(t, loads) for t in TABLES[1:]], top_df,
                              persist=lambda df, name: tables.write(load, name, df))
    tables.write(load, "university", rows)
    remove(tables.spark, scratch)


def run_stream(stream: DataFrame, checkpoint: str, load) -> None:
    """Give what is there to ``load(batch, batch id, stream id)``, batch by batch, and stop."""
    started, stream_id = threading.Event(), []

    def each(df, batch_id):
        started.wait()
        load(df, batch_id, stream_id[0])

    query = (stream.writeStream.foreachBatch(each)
             .outputMode("update")  # without an aggregate the same as append
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    stream_id.append(str(query.id))  # kept in the checkpoint, so a restarted stream has the same
    started.set()
    query.awaitTermination()


def landed(spark: SparkSession, landing: str, levels: list[str]) -> DataFrame:
    """The pages landed under a root, as a stream."""
    return (spark.readStream.schema(landing_schema(levels))
            .option("mode", "FAILFAST").json(landing))


def run_available(spark: SparkSession, landing: str, state_root: str, checkpoint: str,
                  levels: list[str], k: int = TOP_K, on_repeat: str = "raise") -> StoredTables:
    """Process every page landed since the last run, then stop."""
    tables = StoredTables(spark, state_root)
    run_stream(landed(spark, landing, levels), checkpoint,
               lambda df, batch, query: process_batch(tables, df, batch, query, k, on_repeat))
    tables.fold()
    return tables


def run_live(spark: SparkSession, url: str, state_root: str, checkpoint: str, k: int = TOP_K,
             on_repeat: str = "raise", **options) -> StoredTables:
    """Load every record that the API has added since the last run, then stop.

    The stream's offset is the next record of the API's sequence, so nothing
    is landed in between, no page is lost and none is read twice.
    """
    tables = StoredTables(spark, state_root)
    run_stream(stream_pages(spark, url, **options), checkpoint,
               lambda df, batch, query: process_batch(tables, df, batch, query, k, on_repeat))
    tables.fold()
    return tables


def ingest_live(spark: SparkSession, url: str, out: str, checkpoint: str, **options) -> DataFrame:
    """Append the API's new records to the Parquet folder ``out``; all ingested so far are returned.

    A batch has a folder of its own, which a replay after a failure writes
    again.
    """
    def append(df, batch, query):
        flatten_record(unnest_pages(df)).write.mode("overwrite").parquet(f"{out}/batch={query}-{batch}")

    run_stream(stream_pages(spark, url, **options), checkpoint, append)
    schema = T.StructType([*[T.StructField(plain, kind) for _, plain, kind in API_FIELDS],
                           T.StructField("page", T.LongType()), T.StructField("pos", T.LongType())])
    return spark.read.schema(schema).parquet(out)
