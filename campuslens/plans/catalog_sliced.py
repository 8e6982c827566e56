"""Registered queries: slicers on every card and chart, distinct cards, run-time pruning, SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from campuslens.plans import catalog as C
from campuslens.plans import cube as CU
from campuslens.plans import dashboard as DB
from campuslens.plans import load as L
from campuslens.plans import sql as S
from campuslens.plans import sql_functions as SF
from campuslens.plans.catalog import ALL_FACT, BASE, FULL_TWO, query
from campuslens.sources.standin import course
from campuslens.sources.tables import store_partitioned

STATES, TYPES, BANDS = ["ASIA", "EUROPE", "AFRICA"], ["Public", "Private For-Profit", "Unknown"], ["Open", "Selective"]
# Facts with state and type beside the band, sliced.
_RATES = ALL_FACT + (",\nsliced AS (SELECT u.*, r.selectivity, r.reported_rate FROM university u"
                     " JOIN rates r ON u.school_id = r.school_id WHERE {})")


def _where(states=None, types=None, bands=None) -> str:
    parts = [f"{c} IN ({C._list_sql(v)})" for c, v in
             (("u.state", states), ("u.school_type", types), ("r.selectivity", bands)) if v]
    return " AND ".join(parts) or "true"


def _cube(spark, sf):
    """The cube of all schools, stored: every card and chart reads its few rows."""
    return L.stage(CU.measure_cube(L.filled_schools(spark, sf)), "cube")


@query("sliced_cards", _RATES.format(_where(STATES, TYPES)) + " SELECT count(*) AS schools,"
       " round(avg(nullif(in_state_tuition, 0)), 6) AS avg_in_state_tuition,"
       " round(avg(nullif(out_of_state_tuition, 0)), 6) AS avg_out_of_state_tuition FROM sliced")
def sliced_cards(spark, sf):
    """Cards of the overview page under a state and a type slicer."""
    return CU.cards(_cube(spark, sf), state=STATES, school_type=TYPES)


@query("sliced_graduation_by_type", _RATES.format(_where(STATES, None, BANDS)) + " SELECT school_type,"
       " round(avg(nullif(graduation_rate, 0)), 6) AS avg_graduation_rate,"
       " count(nullif(graduation_rate, 0)) AS reported, count(*) AS schools FROM sliced GROUP BY 1")
def sliced_graduation_by_type(spark, sf):
    return CU.graduation_by_type(_cube(spark, sf), state=STATES, selectivity=BANDS)


@query("sliced_retention_vs_selectivity", _RATES.format(_where(STATES)) + " SELECT selectivity,"
       " round(avg(nullif(retention_rate, 0)), 6) AS avg_retention_rate,"
       " round(avg(reported_rate), 6) AS avg_admission_rate, count(*) AS schools FROM sliced GROUP BY 1")
def sliced_retention_vs_selectivity(spark, sf):
    return CU.retention_vs_selectivity(_cube(spark, sf), state=STATES)


@query("sliced_selectivity_distribution", _RATES.format(_where(None, TYPES)) + " SELECT selectivity, count(*) AS schools,"
       " round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share FROM sliced GROUP BY 1")
def sliced_selectivity_distribution(spark, sf):
    return CU.selectivity_distribution(_cube(spark, sf), school_type=TYPES)


@query("sliced_admission_summary", _RATES.format(_where(STATES, TYPES)) + " SELECT selectivity, count(*) AS schools,"
       " round(avg(nullif(average_sat_score, 0)), 6) AS avg_sat, min(nullif(average_sat_score, 0)) AS min_sat,"
       " max(nullif(average_sat_score, 0)) AS max_sat, round(avg(reported_rate), 6) AS avg_admission_rate,"
       " min(reported_rate) AS min_admission_rate, max(reported_rate) AS max_admission_rate FROM sliced GROUP BY 1")
def sliced_admission_summary(spark, sf):
    return CU.admission_summary(_cube(spark, sf), state=STATES, school_type=TYPES)


@query("sliced_distinct_cards", FULL_TWO + f""",
both_loads AS (SELECT * FROM e_university UNION ALL SELECT * FROM l_university),
picked AS (SELECT * FROM both_loads WHERE school_type IN ({C._list_sql(TYPES)}))
SELECT state, count(DISTINCT school_id) AS total_universities, count(DISTINCT program_id) AS total_programs,
       count(DISTINCT program_type_id) AS total_program_types
FROM picked GROUP BY GROUPING SETS ((state), ())""")
def sliced_distinct_cards(spark, sf):
    """Distinct schools, programs and program types over the facts of two loads, by state and in all."""
    facts = L.full_load(spark, sf, "earlier").unionByName(L.full_load(spark, sf, "later"))
    cube = L.stage(CU.distinct_cube(facts, ["state", "school_type"]), "distinct-cube")
    by_state = CU.distinct_cards(cube, ["state"], school_type=TYPES)
    return by_state.unionByName(CU.distinct_cards(cube, school_type=TYPES).withColumn(
        "state", F.lit(None).cast("string")))


@query("program_type_page", f"{ALL_FACT} SELECT dt.program_type, u.state, count(*) AS schools,"
       " round(avg(nullif(u.in_state_tuition, 0)), 6) AS avg_in_state_tuition"
       " FROM university u JOIN dim_program_type dt ON u.program_type_id = dt.program_type_id"
       " WHERE dt.program_type LIKE '%selective%' GROUP BY 1, 2")
def program_type_page(spark, sf):
    """Schools by state for the program types that a text filter finds.

    The fact lies in a folder a program type; which folders are read is
    known only once the dimension is filtered (dynamic partition pruning).
    """
    fact, _, dim_type = L.full_load_tables(spark, sf, columns=["state", "in_state_tuition"])
    stored = store_partitioned(fact, "program_type_id", "university")
    dim = L.stage(dim_type, "dim")
    return DB.schools_of_types(stored, dim.where(F.col("program_type").contains("selective")))


def _functions(spark, sf, ids=False, courses=False):
    """The SQL functions over every school, under the prefix ``cl_``."""
    records, fact, programs = L.school(spark, sf), None, None
    if ids:
        fact, programs, _ = L.full_load_tables(spark, sf, columns=["school_id", "state", "school_type", "in_state_tuition"])
    SF.register(spark, records, fact, programs, course(spark, sf) if courses else None, "cl_")


@query("sql_rank_sliced", "WITH " + S.base_ctes(school_where=f"state IN ({C._list_sql(STATES)}) AND"
       f" school_type IN ({C._list_sql(TYPES)})", k=100) + " SELECT * FROM top")
def sql_rank_sliced(spark, sf):
    """The ranking table under slicers, asked in SQL."""
    _functions(spark, sf)
    return spark.sql("SELECT * FROM cl_rank_schools(k => 100, states => :states, school_types => :types)",
                     {"states": F.array(*map(F.lit, STATES)), "types": F.array(*map(F.lit, TYPES))})


@query("sql_resort_ranking", f"{BASE} SELECT *, CAST(row_number() OVER (ORDER BY earnings_after_10yrs ASC NULLS LAST,"
                             " school_id) AS INTEGER) AS position FROM top")
def sql_resort_ranking(spark, sf):
    """The ranking table re-sorted by a column that the user names, asked in SQL."""
    _functions(spark, sf)
    return spark.sql("SELECT * FROM cl_resort_ranking('earnings_after_10yrs', descending => false)")


@query("sql_custom_bands", f"{ALL_FACT}, b AS (SELECT CASE WHEN r.reported_rate IS NULL THEN 'Not Reported'"
       " WHEN r.reported_rate <= 0.2 THEN 'hard' WHEN r.reported_rate <= 0.6 THEN 'medium' ELSE 'easy' END AS selectivity"
       f" FROM rates r JOIN university u ON u.school_id = r.school_id WHERE u.state IN ({C._list_sql(STATES)}))"
       " SELECT selectivity, count(*) AS schools, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share"
       " FROM b GROUP BY 1")
def sql_custom_bands(spark, sf):
    """Selectivity bands with the user's own bounds and labels, asked in SQL."""
    _functions(spark, sf)
    return spark.sql("SELECT * FROM cl_selectivity_distribution(states => array('ASIA', 'EUROPE', 'AFRICA'),"
                     " bounds => array(0.2D, 0.6D), labels => array('hard', 'medium'), above => 'easy')")


@query("sql_programs", f"{ALL_FACT} SELECT u.program_id, d.program_name, count(*) AS schools,"
       " round(avg(nullif(u.in_state_tuition, 0)), 6) AS avg_in_state_tuition"
       " FROM university u LEFT JOIN dim_program d ON u.program_id = d.program_id"
       f" WHERE u.state IN ({C._list_sql(STATES)}) GROUP BY u.program_id, d.program_name")
def sql_programs(spark, sf):
    """The program page under a state slicer, asked in SQL."""
    _functions(spark, sf, ids=True)
    return spark.sql("SELECT * FROM cl_schools_by_program(states => array('ASIA', 'EUROPE', 'AFRICA'))")
