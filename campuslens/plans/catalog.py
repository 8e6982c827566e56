"""Registry of named queries: a Spark callable and its DuckDB oracle SQL.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the driver's tables (or over files Spark derived from them during the call,
for the source/sink operators). Column names and types match the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslens.functions import codes
from campuslens.functions.measures import NOT_REPORTED
from campuslens.operators import dims as D
from campuslens.operators import fill as FL
from campuslens.operators import rank as R
from campuslens.operators.decode import decode
from campuslens.operators.upsert import check_source_unique, latest_per_key, upsert
from campuslens.plans import dashboard as DB
from campuslens.plans import load as L
from campuslens.plans import sql as S
from campuslens.schemas import FACT_COLUMNS, RAW_COLUMNS, RECORD_COLUMNS
from campuslens.session import scratch_path
from campuslens.sources import pages as PG
from campuslens.sources.tables import append_rows, store_bucketed
from campuslens.sources.standin import (EARLIER_RUN, LATER_RUN, course,
                                        course_counts, school_raw)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Slicer and re-sort choices used by the registered dashboard queries.
SLICE_STATES = ["AMERICA", "EUROPE"]
SLICE_TYPES = ["Public", "Private Nonprofit"]
RANK_STATES = ["AMERICA", "ASIA"]
RESORT_COLUMN = "out_of_state_tuition"
PROJECTED_FIELDS = ["id", "school.name", "school.state",
                    "latest.admissions.admission_rate.overall"]


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# SQL building blocks
# ---------------------------------------------------------------------------
BASE = "WITH " + S.base_ctes()
E_WIN = dict(since=EARLIER_RUN[0], until=EARLIER_RUN[1], reported_only=True, old_codes=True)
L_WIN = dict(since=LATER_RUN[0], until=LATER_RUN[1], reported_only=True)
TWO_RUNS = ("WITH " + S.base_ctes(**E_WIN, prefix="e_") + "," + S.base_ctes(**L_WIN, prefix="l_")
            + "," + S.dim_ctes("e_top", "e_") + "," + S.dim_ctes("l_top", "l_"))
ALL_FACT = "WITH " + S.full_load_ctes()
COURSE_CTE = """
course AS (
    SELECT DISTINCT o.o_custkey AS school_id, p.p_partkey AS course_id, p.p_name AS course_name,
           p.p_brand AS department, p.p_type AS program_level, p.p_size AS credit_hours,
           p.p_retailprice AS tuition
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey)"""


def _upserted_dim_sql(value: str, id_col: str) -> str:
    """Stored earlier dimension plus new later names, continuing its ids."""
    dim = "dim_program" if id_col == "program_id" else "dim_program_type"
    return f"""
    SELECT {id_col}, {value} FROM e_{dim}
    UNION ALL
    SELECT CAST((SELECT coalesce(max({id_col}), 0) FROM e_{dim})
                + row_number() OVER (ORDER BY min(rank)) AS INTEGER) AS {id_col}, {value}
    FROM l_top t
    WHERE NOT EXISTS (SELECT 1 FROM e_{dim} d WHERE d.{value} = t.{value})
    GROUP BY {value}"""


UPSERTED_DIMS = (f",\nu_dim_program AS ({_upserted_dim_sql('program_name', 'program_id')}),"
                 f"\nu_dim_program_type AS ({_upserted_dim_sql('program_type', 'program_type_id')})")


def _upsert_sql(target: str, source: str) -> str:
    cols = []
    for c in FACT_COLUMNS:
        if c == "school_id":
            cols.append("coalesce(s.school_id, t.school_id) AS school_id")
        else:
            cols.append(f"CASE WHEN s.school_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
    return f"SELECT {', '.join(cols)} FROM {target} t FULL OUTER JOIN {source} s ON t.school_id = s.school_id"


def _list_sql(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ---------------------------------------------------------------------------
# Shared Spark inputs
# ---------------------------------------------------------------------------
def _school(spark, sf):
    return L.school(spark, sf)


def _university(spark, sf):
    """Every school for measures that use no id: lazy, pruned by the measure."""
    return L.filled_schools(spark, sf)


def _land_standin(spark, sf, name="pages", run=None, empties=False):
    raw = school_raw(spark, sf, **L.run_window(run))
    path = scratch_path(spark, name)
    PG.land_pages(raw, path)
    if empties:
        PG.land_empty_pages(spark, path, raw.agg(F.max("page").alias("page")))
    return path


# ---------------------------------------------------------------------------
# Phase 0: rank, cut, fill (flagship)
# ---------------------------------------------------------------------------
@query("ranked_top_1000", f"{BASE} SELECT * FROM top")
def ranked_top_1000(spark, sf):
    return L.top(spark, sf)


@query("top_1000", f"{BASE} SELECT {', '.join(RECORD_COLUMNS)} FROM ranked")
def top_1000(spark, sf):
    return R.top_k(_school(spark, sf))


@query("rank_sort", f"{BASE} SELECT *, CAST(row_number() OVER (ORDER BY {S.order_by_sql()}) AS BIGINT)"
                    " AS sort_pos FROM school")
def rank_sort(spark, sf):
    return R.rank_sort(_school(spark, sf))


@query("fill_zero", f"{BASE} SELECT school_id, " + ", ".join(
    "coalesce(price_calculator, '0') AS price_calculator" if c == "price_calculator"
    else f"coalesce({c}, CAST(0 AS DOUBLE)) AS {c}" for c in FL.ZERO_FILL_COLUMNS) + " FROM ranked")
def fill_zero(spark, sf):
    return FL.fill_zero(R.ranked_top_k(_school(spark, sf))).select("school_id", *FL.ZERO_FILL_COLUMNS)


@query("fill_admission_rate", f"{BASE} SELECT school_id, coalesce(admission_rate, CAST(1 AS DOUBLE))"
                              " AS admission_rate FROM ranked")
def fill_admission_rate(spark, sf):
    return FL.fill_admission_rate(R.ranked_top_k(_school(spark, sf))).select("school_id", "admission_rate")


@query("cast_price_calculator", f"{BASE} SELECT school_id, price_calculator FROM top")
def cast_price_calculator(spark, sf):
    return L.top(spark, sf).select("school_id", "price_calculator")


@query("preview", "WITH school_raw AS (" + S.school_raw_sql() + "), first_rows AS ("
                  "SELECT * FROM school_raw ORDER BY page, pos LIMIT 5) " + S.school_sql("first_rows"))
def preview(spark, sf):
    return decode(school_raw(spark, sf).orderBy("page", "pos").limit(5))


@query("ranking_filtered", "WITH " + S.base_ctes(school_where=f"state IN ({_list_sql(RANK_STATES)})")
       + " SELECT * FROM top")
def ranking_filtered(spark, sf):
    return L.transform(DB.slice_facts(_school(spark, sf), states=RANK_STATES))


@query("ranking_resort", f"{BASE} SELECT *, CAST(row_number() OVER (ORDER BY {RESORT_COLUMN} DESC NULLS LAST,"
                         " school_id) AS INTEGER) AS position FROM top")
def ranking_resort(spark, sf):
    return R.resort(L.top(spark, sf), RESORT_COLUMN)


# ---------------------------------------------------------------------------
# Phase 1: decode and projection
# ---------------------------------------------------------------------------
def _decode_direct(name, code_col, out_col, table, default, cast_int=False):
    expr = S.case_lookup(code_col, table, default)
    if cast_int:
        expr = f"CAST({expr} AS INTEGER)"
    sql = f"WITH school_raw AS ({S.school_raw_sql()}) SELECT school_id, {code_col}, {expr} AS {out_col} FROM school_raw"

    @query(name, sql)
    def fn(spark, sf):
        column = codes.lookup(F.col(code_col), table, default)
        if cast_int:
            column = column.cast("int")
        return school_raw(spark, sf).select("school_id", code_col, column.alias(out_col))
    return fn


_decode_direct("decode_ownership", "ownership", "school_type", codes.OWNERSHIP, codes.UNKNOWN)
_decode_direct("decode_program_name", "carnegie_basic", "program_name", codes.PROGRAM_NAME, codes.UNKNOWN)
_decode_direct("decode_program_type", "carnegie_undergrad", "program_type", codes.PROGRAM_TYPE, codes.UNKNOWN)
_decode_direct("decode_duration", "level", "duration", codes.DURATION, codes.UNKNOWN)
_decode_direct("research_tier", "carnegie_basic", "research_output", codes.RESEARCH_TIER,
               codes.DEFAULT_TIER, cast_int=True)


@query("project_fact", f"{BASE}, {S.dim_ctes()}, {S.fact_cte()} SELECT * FROM fact")
def project_fact_q(spark, sf):
    return L.fact(L.stage(L.top(spark, sf), "top"))


@query("profile_columns", f"{BASE} " + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS ordinal, '{c}' AS column_name, '{{t_{c}}}' AS data_type,"
    f" count({c}) AS non_null, count(*) - count({c}) AS nulls FROM school"
    for i, c in enumerate(RECORD_COLUMNS)))
def profile_columns(spark, sf):
    return DB.profile_columns(_school(spark, sf))


_SPARK_TYPES = {c: ("bigint" if c == "school_id" else "int" if c == "research_output" else
                    "string" if c in ("name", "city", "state", "school_type", "school_url",
                                      "price_calculator", "program_name", "duration", "program_type")
                    else "double") for c in RECORD_COLUMNS}
ORACLES["profile_columns"] = ORACLES["profile_columns"].format(
    **{f"t_{c}": t for c, t in _SPARK_TYPES.items()})


# ---------------------------------------------------------------------------
# Phase 2: dimensions
# ---------------------------------------------------------------------------
@query("distinct_program", f"{BASE} SELECT program_name, min(rank) AS first_rank FROM top GROUP BY program_name")
def distinct_program(spark, sf):
    return D.first_occurrence(L.top(spark, sf), "program_name")


@query("distinct_program_type", f"{BASE} SELECT program_type, min(rank) AS first_rank FROM top GROUP BY program_type")
def distinct_program_type(spark, sf):
    return D.first_occurrence(L.top(spark, sf), "program_type")


@query("dim_program_ids", f"{BASE}, {S.dim_ctes()} SELECT * FROM dim_program")
def dim_program_ids(spark, sf):
    return L.frame_dims(L.top(spark, sf))[0]


@query("dim_program_type_ids", f"{BASE}, {S.dim_ctes()} SELECT * FROM dim_program_type")
def dim_program_type_ids(spark, sf):
    return L.frame_dims(L.top(spark, sf))[1]


@query("dim_drop_null", f"{BASE} SELECT program_name, min(rank) AS first_rank FROM ("
                        f"SELECT nullif(program_name, '{codes.UNKNOWN}') AS program_name, rank FROM top)"
                        " WHERE program_name IS NOT NULL GROUP BY program_name")
def dim_drop_null(spark, sf):
    known = L.top(spark, sf).withColumn(
        "program_name", F.nullif(F.col("program_name"), F.lit(codes.UNKNOWN)))
    return D.first_occurrence(D.drop_null_names(known, "program_name"), "program_name")


@query("dim_new_names", f"{TWO_RUNS} SELECT program_name, min(rank) AS first_rank FROM l_top t"
                        " WHERE NOT EXISTS (SELECT 1 FROM e_dim_program d WHERE d.program_name = t.program_name)"
                        " GROUP BY program_name")
def dim_new_names(spark, sf):
    _, dp, _, later = L.two_run_state(spark, sf)
    return D.new_names(dp, later, "program_name")


@query("dim_next_ids", f"{TWO_RUNS} SELECT CAST((SELECT coalesce(max(program_type_id), 0) FROM e_dim_program_type)"
                       " + row_number() OVER (ORDER BY min(rank)) AS INTEGER) AS program_type_id, program_type"
                       " FROM l_top t WHERE NOT EXISTS (SELECT 1 FROM e_dim_program_type d"
                       " WHERE d.program_type = t.program_type) GROUP BY program_type")
def dim_next_ids(spark, sf):
    _, _, dt, later = L.two_run_state(spark, sf)
    return D.next_ids(dt, later, "program_type", "program_type_id")


@query("dim_upsert", f"{TWO_RUNS}{UPSERTED_DIMS} SELECT 'dim_program' AS dimension, program_id AS id,"
                     " program_name AS name FROM u_dim_program UNION ALL SELECT 'dim_program_type',"
                     " program_type_id, program_type FROM u_dim_program_type")
def dim_upsert(spark, sf):
    _, dp, dt, later = L.two_run_state(spark, sf)
    up, ut = L.upsert_dims(dp, dt, later)
    return (up.select(F.lit("dim_program").alias("dimension"), F.col("program_id").alias("id"),
                      F.col("program_name").alias("name"))
            .unionByName(ut.select(F.lit("dim_program_type").alias("dimension"),
                                   F.col("program_type_id").alias("id"),
                                   F.col("program_type").alias("name"))))


@query("dim_upsert_program", f"{TWO_RUNS}{UPSERTED_DIMS} SELECT * FROM u_dim_program")
def dim_upsert_program(spark, sf):
    _, dp, dt, later = L.two_run_state(spark, sf)
    return L.upsert_dims(dp, dt, later)[0]


@query("dim_upsert_program_type", f"{TWO_RUNS}{UPSERTED_DIMS} SELECT * FROM u_dim_program_type")
def dim_upsert_program_type(spark, sf):
    _, dp, dt, later = L.two_run_state(spark, sf)
    return L.upsert_dims(dp, dt, later)[1]


@query("dim_bootstrap", f"{BASE}, {S.dim_ctes()} SELECT 'dim_program' AS dimension, program_id AS id,"
                        " program_name AS name FROM dim_program UNION ALL SELECT 'dim_program_type', program_type_id,"
                        " program_type FROM dim_program_type")
def dim_bootstrap(spark, sf):
    """``CREATE TABLE IF NOT EXISTS`` both dimensions, then the first load's upsert."""
    root = scratch_path(spark, "dims")
    suffix = root.rsplit("-", 1)[-1]
    names = {}
    for dim, (value, id_col, _) in (("dim_program", L.PROGRAM), ("dim_program_type", L.PROGRAM_TYPE)):
        names[dim] = f"{dim}_{suffix}"
        for _ in range(2):  # idempotent: the second statement is a no-op
            spark.sql(f"CREATE TABLE IF NOT EXISTS {names[dim]} ({id_col} INT, {value} VARCHAR(255))"
                      f" USING parquet LOCATION '{root}/{dim}'")
    first = L.stage(L.top(spark, sf))
    for dim, (value, id_col, _) in (("dim_program", L.PROGRAM), ("dim_program_type", L.PROGRAM_TYPE)):
        stored = spark.table(names[dim])
        D.next_ids(stored, first, value, id_col).select(id_col, value).write.insertInto(names[dim])
    out = None
    for dim, (value, id_col, _) in (("dim_program", L.PROGRAM), ("dim_program_type", L.PROGRAM_TYPE)):
        # the files stay readable; the catalog entry of this run goes
        part = (spark.read.schema(spark.table(names[dim]).schema).parquet(f"{root}/{dim}")
                .select(F.lit(dim).alias("dimension"), F.col(id_col).alias("id"),
                        F.col(value).cast("string").alias("name")))
        spark.sql(f"DROP TABLE {names[dim]}")
        out = part if out is None else out.unionByName(part)
    return out


@query("check_dim_unique", f"{TWO_RUNS}{UPSERTED_DIMS} " + " UNION ALL ".join(
    f"""SELECT '{d}' AS dimension, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_names,
        count(*) FILTER (WHERE n > 1) AS repeated_names,
        (SELECT count(DISTINCT {i}) FROM u_{d}) AS distinct_ids,
        (SELECT count(*) FROM (SELECT {i} FROM u_{d} GROUP BY {i} HAVING count(*) > 1)) AS repeated_ids
        FROM (SELECT {v}, count(*) AS n FROM u_{d} GROUP BY {v})"""
    for d, v, i in (("dim_program", "program_name", "program_id"),
                    ("dim_program_type", "program_type", "program_type_id"))))
def check_dim_unique(spark, sf):
    _, dp, dt, later = L.two_run_state(spark, sf)
    up, ut = L.upsert_dims(dp, dt, later)
    return (D.check_unique(up, "program_name", "program_id", "dim_program")
            .unionByName(D.check_unique(ut, "program_type", "program_type_id", "dim_program_type")))


@query("attach_program_id", f"{BASE}, {S.dim_ctes()} SELECT t.school_id, t.program_name, d.program_id"
                            " FROM top t LEFT JOIN dim_program d ON t.program_name = d.program_name")
def attach_program_id(spark, sf):
    t = L.stage(L.top(spark, sf), "top")
    dp, dt = L.frame_dims(t)
    return L.with_ids(t, dp, dt).select("school_id", "program_name", "program_id")


@query("attach_program_type_id", f"{BASE}, {S.dim_ctes()} SELECT t.school_id, t.program_type, d.program_type_id"
                                 " FROM top t LEFT JOIN dim_program_type d ON t.program_type = d.program_type")
def attach_program_type_id(spark, sf):
    t = L.stage(L.top(spark, sf), "top")
    dp, dt = L.frame_dims(t)
    return L.with_ids(t, dp, dt).select("school_id", "program_type", "program_type_id")


def _refresh_sql(value, id_col, dim):
    return (f"{TWO_RUNS}{UPSERTED_DIMS} SELECT t.school_id, t.{value}, l.{id_col} AS local_{id_col},"
            f" u.{id_col} FROM l_top t LEFT JOIN l_{dim} l ON t.{value} = l.{value}"
            f" LEFT JOIN u_{dim} u ON t.{value} = u.{value}")


def _refresh(spark, sf, which):
    _, dp, dt, later = L.two_run_state(spark, sf)
    local_p, local_t = L.frame_dims(later)
    staged = L.with_ids(later, local_p, local_t)
    value, id_col, _ = (L.PROGRAM, L.PROGRAM_TYPE)[which]
    up, ut = (L.stage(d, "dim") for d in L.upsert_dims(dp, dt, later))
    refreshed = L.refresh_ids(staged.withColumnRenamed(id_col, f"local_{id_col}"), up, ut)
    return refreshed.select("school_id", value, f"local_{id_col}", id_col)


@query("refresh_program_id", _refresh_sql("program_name", "program_id", "dim_program"))
def refresh_program_id(spark, sf):
    return _refresh(spark, sf, 0)


@query("refresh_program_type_id", _refresh_sql("program_type", "program_type_id", "dim_program_type"))
def refresh_program_type_id(spark, sf):
    return _refresh(spark, sf, 1)


# ---------------------------------------------------------------------------
# Phase 3: fact upsert
# ---------------------------------------------------------------------------
FULL_TWO = "WITH " + S.full_load_ctes(**E_WIN, prefix="e_") + "," + S.full_load_ctes(**L_WIN, prefix="l_")


@query("fact_upsert", f"{FULL_TWO} {_upsert_sql('e_university', 'l_university')}")
def fact_upsert(spark, sf):
    """Whole-table upsert into a stored fact bucketed by key: the stored side is not shuffled."""
    stored = store_bucketed(L.full_load(spark, sf, "earlier"), "university", "school_id")
    return upsert(stored, L.full_load(spark, sf, "later"), "school_id").select(*FACT_COLUMNS)


@query("check_source_unique", f"{ALL_FACT} SELECT CAST(sum(n) AS BIGINT) AS rows, count(school_id) AS distinct_keys,"
                              " count(*) FILTER (WHERE school_id IS NOT NULL AND n > 1) AS repeated_keys,"
                              " CAST(coalesce(sum(n) FILTER (WHERE school_id IS NULL), 0) AS BIGINT) AS null_key_rows"
                              " FROM (SELECT school_id, count(*) AS n FROM university GROUP BY school_id)")
def check_source_unique_q(spark, sf):
    return check_source_unique(L.filled_schools(spark, sf), "school_id")


STAGED = (f",\nstaged AS (SELECT " + ", ".join(
    "d.program_id" if c == "program_id" else "dt.program_type_id" if c == "program_type_id" else f"t.{c}"
    for c in FACT_COLUMNS) + " FROM l_top t LEFT JOIN u_dim_program d ON t.program_name = d.program_name"
    " LEFT JOIN u_dim_program_type dt ON t.program_type = dt.program_type)")
LOAD_SQL = (f"{TWO_RUNS}{UPSERTED_DIMS}, {S.fact_cte('e_top', 'e_', 'fact')}{STAGED} "
            f"{_upsert_sql('e_fact', 'staged')}")


@query("load_university", LOAD_SQL)
def load_university(spark, sf):
    return L.load_university(spark, sf)


@query("bulk_append", f"{BASE}, {S.dim_ctes()}, {S.fact_cte()} SELECT * FROM fact")
def bulk_append(spark, sf):
    """Stage the fact rows: an empty clone of the schema, then an append."""
    path = scratch_path(spark, "staging_university")
    staged = L.fact(L.stage(L.top(spark, sf), "top"))
    append_rows(staged.where(F.lit(False)), path)
    append_rows(staged, path)
    return spark.read.schema(staged.schema).parquet(path)


@query("stage_roundtrip", f"{BASE} SELECT * FROM top")
def stage_roundtrip(spark, sf):
    """Hand-off between stages as a typed parquet snapshot."""
    path = scratch_path(spark, "snapshot")
    snap = L.top(spark, sf)
    snap.write.parquet(path)
    return spark.read.schema(snap.schema).parquet(path)


# ---------------------------------------------------------------------------
# Phase 4: measures (over the fact of every school)
# ---------------------------------------------------------------------------
@query("slice_state_type", f"{ALL_FACT} SELECT * FROM university WHERE state IN ({_list_sql(SLICE_STATES)})"
                           f" AND school_type IN ({_list_sql(SLICE_TYPES)})")
def slice_state_type(spark, sf):
    """Slicers over a stored fact: they reach its scan as pushed filters."""
    stored = L.stage(L.full_load(spark, sf), "university")
    return DB.slice_facts(stored, SLICE_STATES, SLICE_TYPES).select(*FACT_COLUMNS)


@query("avg_excluding_zero", f"{ALL_FACT} SELECT state, round(avg(nullif(average_sat_score, 0)), 6)"
                             " AS avg_average_sat_score, count(*) FILTER (WHERE average_sat_score = 0) AS zeros"
                             " FROM university GROUP BY state")
def avg_excluding_zero(spark, sf):
    return DB.avg_excluding_zero_by_state(_university(spark, sf))


def _display_whole_sql(c):
    return f"CASE WHEN {c} = 0 THEN '{NOT_REPORTED}' ELSE CAST(CAST(round({c}) AS BIGINT) AS VARCHAR) END"


def _display_percent_sql(c):
    return (f"CASE WHEN {c} = 0 THEN '{NOT_REPORTED}' ELSE CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)"
            " || '%' END")


@query("not_reported_display", f"{ALL_FACT} SELECT school_id, {_display_whole_sql('average_sat_score')} AS sat_display,"
                               f" {_display_whole_sql('earnings_after_10yrs')} AS earnings_display,"
                               f" {_display_percent_sql('graduation_rate')} AS graduation_display,"
                               f" {_display_percent_sql('retention_rate')} AS retention_display FROM university")
def not_reported_display(spark, sf):
    return DB.not_reported_display(_university(spark, sf))


@query("selectivity_band", f"{ALL_FACT} SELECT school_id, admission_rate, selectivity FROM rates")
def selectivity_band(spark, sf):
    return DB.retention_points(_university(spark, sf)).select("school_id", "admission_rate", "selectivity")


@query("retention_points", f"{ALL_FACT} SELECT school_id, admission_rate, retention_rate, selectivity FROM rates")
def retention_points(spark, sf):
    return DB.retention_points(_university(spark, sf))


@query("audit_zero_metrics", f"{ALL_FACT} " + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, count(*) FILTER (WHERE {m} = 0) AS zeros, count(*) AS total FROM university"
    for m in DB.METRICS))
def audit_zero_metrics(spark, sf):
    return DB.audit_zero_metrics(_university(spark, sf))


@query("card_total_schools", f"{ALL_FACT} SELECT count(DISTINCT school_id) AS total_universities,"
                             " count(*) AS rows FROM university")
def card_total_schools(spark, sf):
    return DB.card_total_schools(_university(spark, sf))


@query("card_avg_tuition", f"{ALL_FACT} SELECT round(avg(nullif(in_state_tuition, 0)), 6) AS avg_in_state_tuition,"
                           " round(avg(nullif(out_of_state_tuition, 0)), 6) AS avg_out_of_state_tuition"
                           " FROM university")
def card_avg_tuition(spark, sf):
    return DB.card_avg_tuition(_university(spark, sf))


@query("graduation_by_type", f"{ALL_FACT} SELECT school_type, round(avg(nullif(graduation_rate, 0)), 6)"
                             " AS avg_graduation_rate, count(nullif(graduation_rate, 0)) AS reported,"
                             " count(*) AS schools FROM university GROUP BY school_type")
def graduation_by_type(spark, sf):
    return DB.graduation_by_type(_university(spark, sf))


@query("retention_vs_selectivity", f"{ALL_FACT} SELECT selectivity,"
                                   " round(avg(nullif(retention_rate, 0)), 6) AS avg_retention_rate,"
                                   " round(avg(reported_rate), 6) AS avg_admission_rate, count(*) AS schools"
                                   " FROM rates GROUP BY 1")
def retention_vs_selectivity(spark, sf):
    return DB.retention_vs_selectivity(_university(spark, sf))


@query("selectivity_distribution", f"{ALL_FACT} SELECT selectivity, schools,"
                                   " round(CAST(schools AS DOUBLE) / sum(schools) OVER (), 6) AS share FROM ("
                                   "SELECT selectivity, count(*) AS schools FROM rates GROUP BY 1)")
def selectivity_distribution(spark, sf):
    return DB.selectivity_distribution(_university(spark, sf))


@query("admission_summary", f"{ALL_FACT} SELECT selectivity, count(*) AS schools,"
                            " round(avg(nullif(average_sat_score, 0)), 6) AS avg_sat,"
                            " min(nullif(average_sat_score, 0)) AS min_sat, max(nullif(average_sat_score, 0)) AS max_sat,"
                            " round(avg(reported_rate), 6) AS avg_admission_rate,"
                            " min(reported_rate) AS min_admission_rate, max(reported_rate) AS max_admission_rate"
                            " FROM rates GROUP BY 1")
def admission_summary(spark, sf):
    return DB.admission_summary(_university(spark, sf))


@query("card_total_programs", f"{ALL_FACT} SELECT count(DISTINCT program_id) AS total_programs,"
                              " count(DISTINCT program_type_id) AS total_program_types FROM university")
def card_total_programs(spark, sf):
    return DB.card_total_programs(L.full_load_tables(spark, sf, columns=["school_id"])[0])


@query("schools_by_program", f"{ALL_FACT} SELECT u.program_id, d.program_name, count(*) AS schools,"
                             " round(avg(nullif(u.in_state_tuition, 0)), 6) AS avg_in_state_tuition"
                             " FROM university u LEFT JOIN dim_program d ON u.program_id = d.program_id"
                             " GROUP BY u.program_id, d.program_name")
def schools_by_program(spark, sf):
    fact, dim_program, _ = L.full_load_tables(spark, sf, columns=["in_state_tuition"])
    return DB.schools_by_program(fact, dim_program)


@query("card_avg_credit_hours", f"WITH {COURSE_CTE} SELECT round(avg(nullif(CAST(credit_hours AS DOUBLE), 0)), 6)"
                                " AS avg_credit_hours, count(*) AS courses FROM course")
def card_avg_credit_hours(spark, sf):
    return DB.card_avg_credit_hours(course_counts(spark, sf))


@query("top_departments", f"WITH {COURSE_CTE} SELECT department, count(*) AS courses,"
                          " CAST(row_number() OVER (ORDER BY count(*) DESC, department) AS INTEGER) AS position"
                          " FROM course GROUP BY department ORDER BY courses DESC, department LIMIT 10")
def top_departments(spark, sf):
    return DB.top_departments(course_counts(spark, sf))


@query("levels_by_type", f"{ALL_FACT}, {COURSE_CTE} SELECT u.school_type, c.program_level,"
                         " count(*) AS courses FROM course c JOIN university u ON c.school_id = u.school_id"
                         " GROUP BY u.school_type, c.program_level")
def levels_by_type(spark, sf):
    return DB.levels_by_type(course(spark, sf), _university(spark, sf))


@query("course_detail", f"{ALL_FACT}, {COURSE_CTE} SELECT c.school_id, u.name, c.course_id, c.course_name,"
                        " c.department, c.credit_hours, c.tuition AS course_tuition,"
                        f" {_display_whole_sql('u.in_state_tuition')} AS in_state_tuition_display,"
                        f" {_display_percent_sql('u.financial_aid_percent')} AS financial_aid_display"
                        " FROM course c JOIN university u ON c.school_id = u.school_id")
def course_detail(spark, sf):
    return DB.course_detail(course(spark, sf), _university(spark, sf))


# ---------------------------------------------------------------------------
# Phase 5: sources
# ---------------------------------------------------------------------------
RAW_SQL = f"WITH school_raw AS ({S.school_raw_sql()})"


@query("scan_pages", f"{RAW_SQL} SELECT * FROM school_raw")
def scan_pages(spark, sf):
    return PG.extract(spark, _land_standin(spark, sf))


@query("flatten_record", f"{BASE} SELECT * FROM school")
def flatten_record(spark, sf):
    return decode(PG.extract(spark, _land_standin(spark, sf)))


@query("scan_projected", f"{RAW_SQL} SELECT school_id, name, state, admission_rate, page, pos FROM school_raw")
def scan_projected(spark, sf):
    return PG.extract(spark, _land_standin(spark, sf), PROJECTED_FIELDS)


@query("unnest_results", f"{RAW_SQL} SELECT page, count(*) AS records FROM school_raw GROUP BY page")
def unnest_results(spark, sf):
    path = _land_standin(spark, sf, empties=True)
    return PG.read_pages(spark, path, ["id"]).groupBy("page").agg(F.count(F.lit(1)).alias("records"))


# A run that does not report every school lands shorter pages, so a
# record's position is its index among the records present on its page.
_LANDED_POS = ", ".join(RAW_COLUMNS) + (", page, CAST(row_number() OVER (PARTITION BY page ORDER BY pos) - 1"
                                        " AS BIGINT) AS pos")


@query("accumulate_pages", "WITH e AS (" + S.school_raw_sql(**E_WIN) + "), l AS (" + S.school_raw_sql(**L_WIN)
       + f") SELECT 'earlier' AS run, {_LANDED_POS} FROM e UNION ALL SELECT 'later' AS run, {_LANDED_POS} FROM l")
def accumulate_pages(spark, sf):
    """Two loads landed under one root (``run=...``), read back as one scan."""
    root = scratch_path(spark, "landing")
    for run in ("earlier", "later"):
        PG.land_pages(school_raw(spark, sf, **L.run_window(run)), f"{root}/run={run}")
    return PG.extract(spark, root).select("run", *RAW_COLUMNS, "page", "pos")


@query("keep_latest_school", "WITH e AS (" + S.school_raw_sql(**E_WIN) + "), l AS (" + S.school_raw_sql(**L_WIN)
       + f"), landed AS (SELECT 'earlier' AS run, {_LANDED_POS} FROM e UNION ALL"
       f" SELECT 'later' AS run, {_LANDED_POS} FROM l)"
       " SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY school_id"
       " ORDER BY run DESC, page DESC, pos DESC) AS rn FROM landed) WHERE rn = 1")
def keep_latest_school(spark, sf):
    """A school landed by both loads keeps its latest record (run, page, pos)."""
    root = scratch_path(spark, "landing")
    for run in ("earlier", "later"):
        PG.land_pages(school_raw(spark, sf, **L.run_window(run)), f"{root}/run={run}")
    landed = PG.extract(spark, root).select("run", *RAW_COLUMNS, "page", "pos")
    return latest_per_key(landed, "school_id", ["run", "page", "pos"])


# ---------------------------------------------------------------------------
# Phase 6: incremental
# ---------------------------------------------------------------------------
def _upserted_again_sql(value: str, id_col: str, dim: str) -> str:
    return f"""
    SELECT {id_col}, {value} FROM u_{dim}
    UNION ALL
    SELECT CAST((SELECT coalesce(max({id_col}), 0) FROM u_{dim})
                + row_number() OVER (ORDER BY min(rank)) AS INTEGER) AS {id_col}, {value}
    FROM m_top t WHERE NOT EXISTS (SELECT 1 FROM u_{dim} d WHERE d.{value} = t.{value}) GROUP BY {value}"""


# Third step: both runs land again before one load; the later run's record wins.
MISSED_WEEK_SQL = (
    f"{TWO_RUNS}{UPSERTED_DIMS}, {S.fact_cte('e_top', 'e_', 'fact')}{STAGED},\n"
    f"loaded AS ({_upsert_sql('e_fact', 'staged')}),\n"
    "m_school AS (SELECT * FROM l_school UNION ALL SELECT * FROM e_school e"
    " WHERE NOT EXISTS (SELECT 1 FROM l_school l WHERE l.school_id = e.school_id)),\n"
    f"m_ranked AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY {S.order_by_sql()}) AS INTEGER) AS rank"
    f" FROM m_school) WHERE rank <= {R.TOP_K}),\n"
    f"m_top AS ({S.fill_sql('m_ranked', ['rank'])}),\n"
    f"m_dim_program AS ({_upserted_again_sql('program_name', 'program_id', 'dim_program')}),\n"
    f"m_dim_program_type AS ({_upserted_again_sql('program_type', 'program_type_id', 'dim_program_type')}),\n"
    f"{S.fact_cte('m_top', 'm_', 'fact')} {_upsert_sql('loaded', 'm_fact')}")


@query("incremental_upsert", MISSED_WEEK_SQL)
def incremental_upsert(spark, sf):
    """Two weekly runs through the stream, each landed and loaded; then two runs
    landed before one load, as after a missed week."""
    from campuslens.streaming.incremental import run_available

    root = scratch_path(spark, "incremental")
    landing, state, ckpt = f"{root}/landing", f"{root}/state", f"{root}/checkpoint"
    for run in ("earlier", "later"):
        PG.land_pages(school_raw(spark, sf, **L.run_window(run)), f"{landing}/run={run}")
        run_available(spark, landing, state, ckpt, ["run"])
    for run in ("earlier", "later"):
        PG.land_pages(school_raw(spark, sf, **L.run_window(run)), f"{landing}/run=z_{run}")
    tables = run_available(spark, landing, state, ckpt, ["run"])
    return tables.current("university").select(*FACT_COLUMNS)


# ---------------------------------------------------------------------------
# Slicers, SQL functions, hand-offs, live sources: their modules register here.
# ---------------------------------------------------------------------------
from campuslens.plans import catalog_live, catalog_sliced  # noqa: E402, F401
