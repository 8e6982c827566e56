"""The dashboard as SQL table functions with parameters.

``register`` puts the school records, the stored fact's ids and the courses
behind session views and defines one temporary table function a question, so
a SQL user asks

    SELECT * FROM rank_schools(k => 20, states => array('CA', 'NY'))
    SELECT * FROM selectivity_distribution(bounds => array(0.2D, 0.6D), labels => array('hard', 'medium'))

Every function takes the slicers ``states`` and ``school_types`` (null or
left out: all). A call is inlined into the query that makes it, so the
optimizer sees plain filters, aggregates and, for the rankings, a top-k of
every partition. Ranking more than ``spark.sql.optimizer.windowGroupLimitThreshold``
rows (1000) at once is the work of ``operators.rank``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslens.functions.measures import ABOVE_BANDS, NOT_REPORTED, SELECTIVITY_BANDS, reported_rate
from campuslens.operators.fill import fill_missing, flag_reported
from campuslens.operators.rank import TOP_K, rank_key
from campuslens.schemas import RECORD_COLUMNS

SLICERS = "states ARRAY<STRING> DEFAULT NULL, school_types ARRAY<STRING> DEFAULT NULL"
SLICED = ("(states IS NULL OR array_contains(states, f.state))"
          " AND (school_types IS NULL OR array_contains(school_types, f.school_type))")
BOUNDS = "array(" + ", ".join(f"{b}D" for b, _ in SELECTIVITY_BANDS) + ")"
LABELS = "array(" + ", ".join(f"'{name}'" for _, name in SELECTIVITY_BANDS) + ")"
BANDS = (f"bounds ARRAY<DOUBLE> DEFAULT {BOUNDS}, labels ARRAY<STRING> DEFAULT {LABELS},"
         f" above STRING DEFAULT '{ABOVE_BANDS}'")
# the first bound that the rate does not exceed names the band
BAND = (f"CASE WHEN f.reported_rate IS NULL THEN '{NOT_REPORTED}' ELSE coalesce(try_element_at(labels,"
        " CAST(nullif(array_position(transform(bounds, b -> f.reported_rate <= b), true), 0L) AS INT)), above) END")
SHOWN = ", ".join(f"f.{c}" for c in RECORD_COLUMNS)
# Columns by which a user may re-sort the ranking table: its numbers.
SORTABLE = ["admission_rate", "in_state_tuition", "out_of_state_tuition", "average_sat_score", "earnings_after_10yrs",
            "graduation_rate", "faculty_quality", "international_outlook", "revenue_per_student",
            "spending_per_student", "endowment", "retention_rate", "financial_aid_percent", "rank"]


def _avg(column: str) -> str:
    return f"round(avg(nullif({column}, 0D)), 6)"


def _whole(column: str) -> str:
    return f"CASE WHEN {column} = 0 THEN '{NOT_REPORTED}' ELSE CAST(CAST(round({column}) AS BIGINT) AS STRING) END"


def _percent(column: str) -> str:
    return (f"CASE WHEN {column} = 0 THEN '{NOT_REPORTED}'"
            f" ELSE CAST(CAST(round({column} * 100) AS BIGINT) AS STRING) || '%' END")


def _record_type(types: dict[str, str]) -> str:
    return ", ".join(f"{c} {types[c]}" for c in RECORD_COLUMNS)


def statements(p: str, types: dict[str, str]) -> dict[str, str]:
    """name -> (parameters, columns, body) of every function; ``p`` prefixes views and functions."""
    f, c, i = f"{p}schools f", f"{p}courses c", f"{p}school_ids f"
    record = _record_type(types)
    ranked = (f"SELECT {SHOWN}, CAST(row_number() OVER (ORDER BY f.rank_key) AS INT) AS rank FROM {f} WHERE {SLICED}")
    sort_by = "CASE by " + " ".join(f"WHEN '{x}' THEN CAST({x} AS DOUBLE)" for x in SORTABLE) + \
        " ELSE CAST(raise_error('the ranking has no such number: ' || by) AS DOUBLE) END"
    out = {
        "total_schools": (SLICERS, "total_universities BIGINT, rows BIGINT",
                          f"SELECT count(DISTINCT f.school_id), count(*) FROM {f} WHERE {SLICED}"),
        "avg_tuition": (SLICERS, "avg_in_state_tuition DOUBLE, avg_out_of_state_tuition DOUBLE",
                        f"SELECT {_avg('f.in_state_tuition')}, {_avg('f.out_of_state_tuition')} FROM {f} WHERE {SLICED}"),
        "graduation_by_type": (
            SLICERS, "school_type STRING, avg_graduation_rate DOUBLE, reported BIGINT, schools BIGINT",
            f"SELECT f.school_type, {_avg('f.graduation_rate')}, count(nullif(f.graduation_rate, 0D)), count(*)"
            f" FROM {f} WHERE {SLICED} GROUP BY f.school_type"),
        "retention_points": (
            f"{SLICERS}, {BANDS}", "school_id BIGINT, admission_rate DOUBLE, retention_rate DOUBLE, selectivity STRING",
            f"SELECT f.school_id, f.admission_rate, f.retention_rate, {BAND} FROM {f} WHERE {SLICED}"),
        "retention_vs_selectivity": (
            f"{SLICERS}, {BANDS}",
            "selectivity STRING, avg_retention_rate DOUBLE, avg_admission_rate DOUBLE, schools BIGINT",
            f"SELECT band, {_avg('retention_rate')}, round(avg(reported_rate), 6), count(*)"
            f" FROM (SELECT f.*, {BAND} AS band FROM {f} WHERE {SLICED}) GROUP BY band"),
        "selectivity_distribution": (
            f"{SLICERS}, {BANDS}", "selectivity STRING, schools BIGINT, share DOUBLE",
            "SELECT band, n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) FROM (SELECT band, count(*) AS n"
            f" FROM (SELECT {BAND} AS band FROM {f} WHERE {SLICED}) GROUP BY band)"),
        "admission_summary": (
            f"{SLICERS}, {BANDS}",
            "selectivity STRING, schools BIGINT, avg_sat DOUBLE, min_sat DOUBLE, max_sat DOUBLE,"
            " avg_admission_rate DOUBLE, min_admission_rate DOUBLE, max_admission_rate DOUBLE",
            f"SELECT band, count(*), {_avg('average_sat_score')}, min(nullif(average_sat_score, 0D)),"
            " max(nullif(average_sat_score, 0D)), round(avg(reported_rate), 6), min(reported_rate), max(reported_rate)"
            f" FROM (SELECT f.*, {BAND} AS band FROM {f} WHERE {SLICED}) GROUP BY band"),
        "not_reported_display": (
            SLICERS, "school_id BIGINT, sat_display STRING, earnings_display STRING, graduation_display STRING,"
            " retention_display STRING",
            f"SELECT f.school_id, {_whole('f.average_sat_score')}, {_whole('f.earnings_after_10yrs')},"
            f" {_percent('f.graduation_rate')}, {_percent('f.retention_rate')} FROM {f} WHERE {SLICED}"),
        "rank_schools": (f"k INT DEFAULT {TOP_K}, {SLICERS}", f"{record}, rank INT",
                         f"SELECT * FROM ({ranked}) WHERE rank <= k"),
        "resort_ranking": (
            f"by STRING, descending BOOLEAN DEFAULT true, k INT DEFAULT {TOP_K}, {SLICERS}",
            f"{record}, rank INT, position INT",
            "SELECT * EXCEPT (v), CAST(row_number() OVER (ORDER BY v IS NULL, CASE WHEN descending THEN -v ELSE v END,"
            f" school_id) AS INT) AS position FROM (SELECT *, {sort_by} AS v FROM ({ranked}) WHERE rank <= k)"),
        "total_programs": (SLICERS, "total_programs BIGINT, total_program_types BIGINT",
                           f"SELECT count(DISTINCT f.program_id), count(DISTINCT f.program_type_id) FROM {i}"
                           f" WHERE {SLICED}"),
        "schools_by_program": (
            SLICERS, "program_id INT, program_name STRING, schools BIGINT, avg_in_state_tuition DOUBLE",
            f"SELECT a.program_id, d.program_name, a.n, a.t FROM (SELECT f.program_id, count(*) AS n,"
            f" {_avg('f.in_state_tuition')} AS t FROM {i} WHERE {SLICED} GROUP BY f.program_id) a"
            f" LEFT JOIN {p}programs d ON a.program_id = d.program_id"),
        "avg_credit_hours": (
            SLICERS, "avg_credit_hours DOUBLE, courses BIGINT",
            f"SELECT {_avg('CAST(c.credit_hours AS DOUBLE)')}, count(*) FROM {c} LEFT JOIN (SELECT f.school_id,"
            f" true AS kept FROM {f} WHERE {SLICED}) s ON s.school_id = c.school_id"
            " WHERE (states IS NULL AND school_types IS NULL) OR s.kept"),
        "top_departments": (
            "n INT DEFAULT 10", "department STRING, courses BIGINT, position INT",
            "SELECT * FROM (SELECT department, courses, CAST(row_number() OVER (ORDER BY courses DESC, department)"
            f" AS INT) AS position FROM (SELECT c.department, count(*) AS courses FROM {c} GROUP BY c.department))"
            " WHERE position <= n"),
        "levels_by_type": (
            SLICERS, "school_type STRING, program_level STRING, courses BIGINT",
            f"SELECT f.school_type, c.program_level, sum(c.n) FROM (SELECT c.school_id, c.program_level, count(*) AS n"
            f" FROM {c} GROUP BY c.school_id, c.program_level) c JOIN {f} ON f.school_id = c.school_id WHERE {SLICED}"
            " GROUP BY f.school_type, c.program_level"),
        "course_detail": (
            SLICERS, "school_id BIGINT, name STRING, course_id BIGINT, course_name STRING, department STRING,"
            " credit_hours INT, course_tuition DOUBLE, in_state_tuition_display STRING, financial_aid_display STRING",
            "SELECT c.school_id, f.name, c.course_id, c.course_name, c.department, c.credit_hours, c.tuition,"
            f" {_whole('f.in_state_tuition')}, {_percent('f.financial_aid_percent')}"
            f" FROM {c} JOIN {f} ON f.school_id = c.school_id WHERE {SLICED}"),
    }
    return {name: f"CREATE OR REPLACE TEMPORARY FUNCTION {p}{name}({params}) RETURNS TABLE({columns}) RETURN {body}"
            for name, (params, columns, body) in out.items()}


def register(spark: SparkSession, records: DataFrame, ids: DataFrame | None = None, programs: DataFrame | None = None,
             courses: DataFrame | None = None, prefix: str = "") -> list[str]:
    """Define the functions over decoded school ``records``; return their names.

    ``ids`` are fact rows with program ids, ``programs`` the program
    dimension, ``courses`` the course table; the functions that need an
    absent one are not defined. Missing values are filled after the rank key
    is taken, as in a load.
    """
    schools = fill_missing(flag_reported(records.withColumn("rank_key", rank_key())))
    views = {"schools": schools.withColumn("reported_rate", reported_rate(schools)),
             "school_ids": ids, "programs": programs, "courses": courses}
    for name, df in views.items():
        if df is not None:
            df.createOrReplaceTempView(prefix + name)
    defined = []
    for name, sql in statements(prefix, dict(schools.dtypes)).items():
        absent = [v for v, df in views.items() if df is None and f"{prefix}{v} " in sql]
        if not absent:
            spark.sql(sql)
            defined.append(prefix + name)
    return defined
