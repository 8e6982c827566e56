"""Registered queries: hand-offs, checked writes, and the API as a stream and as records."""

from __future__ import annotations

from pyspark.sql import functions as F

from campuslens.plans import load as L
from campuslens.plans import sql as S
from campuslens.plans.catalog import (BASE, FULL_TWO, L_WIN, RAW_SQL, STAGED, UPSERTED_DIMS, _LANDED_POS, E_WIN,
                                      _list_sql, _upsert_sql, query)
from campuslens.schemas import FACT_COLUMNS, RAW_COLUMNS
from campuslens.session import scratch_path
from campuslens.sources import handoff as H
from campuslens.sources import pages as PG
from campuslens.sources.standin import school_raw, serve_api
from campuslens.sources.tables import RepeatedKey, empty_clone, insert_rows, write_checked


# ---------------------------------------------------------------------------
# Hand-off as text, staging into an empty clone, checks inside the write
# ---------------------------------------------------------------------------
@query("stage_text_roundtrip", f"{BASE} SELECT * FROM top")
def stage_text_roundtrip(spark, sf):
    """Hand-off between stages as JSON text: written, read back, every value the same."""
    return H.read_text(spark, H.write_text(L.top(spark, sf), scratch_path(spark, "handoff")))


VARIANT_KEYS = {"school_id": ("id", "long"), "state": ("school.state", "string"),
                "ownership": ("school.ownership", "int"),
                "in_state_tuition": ("latest.cost.tuition.in_state", "double"),
                "retention_rate": ("latest.student.retention_rate.four_year.full_time_pooled", "double")}


@query("handoff_variant", f"{RAW_SQL} SELECT {', '.join(VARIANT_KEYS)} FROM school_raw")
def handoff_variant(spark, sf):
    """Raw records handed over as text and read without a schema: dotted keys of VARIANT values."""
    records = PG.to_api_record(school_raw(spark, sf)).select("record.*")
    path = H.write_text(records, scratch_path(spark, "handoff"))
    return H.read_variant(spark, path).select(
        *[H.field("record", key, kind).alias(name) for name, (key, kind) in VARIANT_KEYS.items()])


@query("empty_clone", "WITH " + S.base_ctes(**L_WIN, prefix="l_") + "," + S.dim_ctes("l_top", "l_") + ","
       + S.fact_cte("l_top", "l_", "fact") + " SELECT * FROM l_fact")
def empty_clone_q(spark, sf):
    """Each load stages its rows in a fresh empty clone of the fact: the later one holds its own only."""
    for run in ("earlier", "later"):
        staged = L.fact(L.stage(L.top(spark, sf, run), "top"))
        empty_clone(spark, staged.schema, "staging_university")
        insert_rows(staged, "staging_university")
    return spark.table("staging_university")


@query("checked_write", f"""{FULL_TWO}, both_loads AS (SELECT * FROM e_university UNION ALL SELECT * FROM l_university)
SELECT 'one load' AS source, true AS committed, count(*) AS stored FROM l_university
UNION ALL SELECT 'both loads', count(*) = count(DISTINCT school_id),
       CASE WHEN count(*) = count(DISTINCT school_id) THEN count(*) ELSE 0 END FROM both_loads""")
def checked_write(spark, sf):
    """A fact written with its key checked by the same job, and one with repeats that is taken back."""
    later = L.stage(L.full_load(spark, sf, "later"), "later")
    out = []
    for source, rows in (("one load", later),
                         ("both loads", later.unionByName(L.full_load(spark, sf, "earlier")))):
        path = scratch_path(spark, "checked")
        try:
            write_checked(rows, path, ["school_id"])
            committed = True
        except RepeatedKey:
            committed = False
        stored = spark.read.schema(rows.schema).parquet(path) if committed else rows.limit(0)
        out.append(stored.agg(F.lit(source).alias("source"), F.lit(committed).alias("committed"),
                              F.count(F.lit(1)).alias("stored")))
    return out[0].unionByName(out[1])


# ---------------------------------------------------------------------------
# The API as records and as a stream
# ---------------------------------------------------------------------------
ASKED_STATES = ["AMERICA", "MIDDLE EAST"]


@query("scan_pushed_filters", f"{RAW_SQL} SELECT {', '.join(RAW_COLUMNS)} FROM school_raw"
       f" WHERE state IN ({_list_sql(ASKED_STATES)}) AND ownership = 1 AND average_sat_score > 800")
def scan_pushed_filters(spark, sf):
    """Slicers at the source: the states go into the requests, the rest stays with Spark."""
    from campuslens.sources.api import read_records

    url = serve_api(school_raw(spark, sf), scratch_path(spark, "api"), by="state")
    records = read_records(spark, url + "/{state}/page-{page}.json", retries=0, pages_per_partition=8)
    return records.where(F.col("state").isin(ASKED_STATES) & (F.col("ownership") == 1)
                         & (F.col("average_sat_score") > 800)).select(*RAW_COLUMNS)


def _served_twice(spark, sf, step):
    """An API that first has three fifths of the schools, then all; ``step(url)`` runs after each."""
    raw, folder = L.stage(school_raw(spark, sf), "raw"), scratch_path(spark, "api")
    cut = raw.agg(F.floor(F.max("school_id") * 3 / 5)).first()[0]
    for served in (raw.where(F.col("school_id") <= cut), raw):
        out = step(serve_api(served, folder) + "/all/page-{page}.json")
    return out


@query("live_pages", f"{RAW_SQL} SELECT {', '.join(RAW_COLUMNS)}, place // 100 AS page, place % 100 AS pos"
       " FROM (SELECT *, row_number() OVER (ORDER BY school_id) - 1 AS place FROM school_raw)")
def live_pages(spark, sf):
    """The API as a stream: the second run resumes within the page where the first one stopped."""
    from campuslens.streaming.incremental import ingest_live

    out, checkpoint = scratch_path(spark, "live"), scratch_path(spark, "live-checkpoint")
    return _served_twice(spark, sf, lambda url: ingest_live(
        spark, url, out, checkpoint, retries=0, pages_per_partition=8).select(*RAW_COLUMNS, "page", "pos"))


_CUT = "(SELECT CAST(floor(max(c_custkey) * 3 / 5) AS BIGINT) FROM customer)"
LIVE_SQL = ("WITH " + S.base_ctes(prefix="e_", school_where=f"school_id <= {_CUT}") + ","
            + S.base_ctes(prefix="l_", school_where=f"school_id > {_CUT}")
            + "," + S.dim_ctes("e_top", "e_") + "," + S.dim_ctes("l_top", "l_"))


@query("live_upsert", f"{LIVE_SQL}{UPSERTED_DIMS}, {S.fact_cte('e_top', 'e_', 'fact')}{STAGED} "
                      f"{_upsert_sql('e_fact', 'staged')}")
def live_upsert(spark, sf):
    """Two loads straight from the API: each ranks and upserts the records added since the last."""
    from campuslens.streaming.incremental import run_live

    state, checkpoint = scratch_path(spark, "live-state"), scratch_path(spark, "live-checkpoint")
    tables = _served_twice(spark, sf, lambda url: run_live(
        spark, url, state, checkpoint, retries=0, pages_per_partition=8))
    return tables.current("university").select(*FACT_COLUMNS)


@query("newest_across_batches", "WITH e AS (" + S.school_raw_sql(**E_WIN) + "), l AS (" + S.school_raw_sql(**L_WIN)
       + f"), landed AS (SELECT 'earlier' AS run, {_LANDED_POS} FROM e UNION ALL"
       f" SELECT 'later' AS run, {_LANDED_POS} FROM l)"
       " SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY school_id"
       " ORDER BY run DESC, page DESC, pos DESC) AS rn FROM landed) WHERE rn = 1")
def newest_across_batches(spark, sf):
    """The earlier run is delivered after the later one: no school falls back to its older record."""
    from campuslens.operators.decode import flatten_record
    from campuslens.operators.upsert import upsert
    from campuslens.streaming import incremental as I
    from campuslens.streaming.latest import newest_records

    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "newest", "newest-checkpoint"))
    versions: list = []

    def load(df, batch, query):
        passed = L.stage(df.select("run", *RAW_COLUMNS, "page", "pos"), path=f"{out}/passed={batch}")
        versions.append(L.stage(upsert(versions[-1], passed, "school_id") if versions else passed,
                                path=f"{out}/table={batch}"))

    for run in ("later", "earlier"):
        PG.land_pages(school_raw(spark, sf, **L.run_window(run)), f"{landing}/run={run}")
        records = flatten_record(PG.unnest_pages(I.landed(spark, landing, ["run"])))
        I.run_stream(newest_records(records, "school_id", ["run", "page", "pos"]), checkpoint, load)
    return versions[-1]
