"""Dashboard questions as DataFrame queries over the fact and course tables.

All groupings are on low-cardinality labels (school type, band, level,
department) and every aggregate is algebraic (count, sum, min, max, avg),
so each runs as a partial aggregate per partition followed by a small final
aggregate: a label that holds a third of all rows costs one partial row per
partition in the shuffle. Filters (slicers) are plain predicates, which the
parquet scan receives as pushed filters when the fact is read from storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campuslens.functions.measures import (avg_excluding_zero, display_percent,
                                           display_whole, reported_rate, rounded,
                                           selectivity_band, zero_as_null)
from campuslens.functions.ids import small_row_number
from campuslens.functions.joins import CHECKED_BOUND, broadcast_if_bounded

METRICS = [
    "admission_rate", "in_state_tuition", "out_of_state_tuition",
    "average_sat_score", "earnings_after_10yrs", "graduation_rate",
    "retention_rate", "financial_aid_percent",
]


def slice_facts(fact: DataFrame, states: list[str] | None = None,
                school_types: list[str] | None = None, **others: list) -> DataFrame:
    """Slicers: keep rows whose state, school type (and any other column
    given as ``column=[values]``) are among the chosen values.

    Each slicer is an ``IN`` predicate, which a parquet scan receives as a
    pushed filter; an empty or missing choice means "all".
    """
    choices = {"state": states, "school_type": school_types, **others}
    out = fact
    for column, values in choices.items():
        if values:
            out = out.where(F.col(column).isin(list(values)))
    return out


def with_band(fact: DataFrame) -> DataFrame:
    rate = reported_rate(fact)
    return fact.withColumn("selectivity", selectivity_band(rate)).withColumn("reported_rate", rate)


def card_total_schools(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_distinct("school_id").alias("total_universities"),
                    F.count(F.lit(1)).alias("rows"))


def card_avg_tuition(fact: DataFrame) -> DataFrame:
    return fact.agg(
        rounded(avg_excluding_zero(F.col("in_state_tuition"))).alias("avg_in_state_tuition"),
        rounded(avg_excluding_zero(F.col("out_of_state_tuition"))).alias("avg_out_of_state_tuition"))


def graduation_by_type(fact: DataFrame) -> DataFrame:
    return fact.groupBy("school_type").agg(
        rounded(avg_excluding_zero(F.col("graduation_rate"))).alias("avg_graduation_rate"),
        F.count(zero_as_null(F.col("graduation_rate"))).alias("reported"),
        F.count(F.lit(1)).alias("schools"))


def avg_excluding_zero_by_state(fact: DataFrame, metric: str = "average_sat_score") -> DataFrame:
    return fact.groupBy("state").agg(
        rounded(avg_excluding_zero(F.col(metric))).alias(f"avg_{metric}"),
        F.count_if(F.col(metric) == 0).alias("zeros"))


def retention_vs_selectivity(fact: DataFrame) -> DataFrame:
    return with_band(fact).groupBy("selectivity").agg(
        rounded(avg_excluding_zero(F.col("retention_rate"))).alias("avg_retention_rate"),
        rounded(F.avg("reported_rate")).alias("avg_admission_rate"),
        F.count(F.lit(1)).alias("schools"))


def retention_points(fact: DataFrame) -> DataFrame:
    return fact.select("school_id", "admission_rate", "retention_rate",
                       selectivity_band(reported_rate(fact)).alias("selectivity"))


def selectivity_distribution(fact: DataFrame) -> DataFrame:
    counts = with_band(fact).groupBy("selectivity").agg(F.count(F.lit(1)).alias("schools"))
    # The share's window runs over the handful of band rows, not over facts.
    total = F.sum("schools").over(Window.partitionBy())
    return counts.withColumn("share", rounded(F.col("schools").cast("double") / total))


def admission_summary(fact: DataFrame) -> DataFrame:
    sat = zero_as_null(F.col("average_sat_score"))
    return with_band(fact).groupBy("selectivity").agg(
        F.count(F.lit(1)).alias("schools"),
        rounded(F.avg(sat)).alias("avg_sat"),
        F.min(sat).alias("min_sat"),
        F.max(sat).alias("max_sat"),
        rounded(F.avg("reported_rate")).alias("avg_admission_rate"),
        F.min("reported_rate").alias("min_admission_rate"),
        F.max("reported_rate").alias("max_admission_rate"))


def card_total_programs(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_distinct("program_id").alias("total_programs"),
                    F.count_distinct("program_type_id").alias("total_program_types"))


def schools_by_program(fact: DataFrame, dim_program: DataFrame) -> DataFrame:
    """Program page: schools and zero-excluding average tuition per program name.

    The fact carries only ``program_id``; the name comes from the program
    dimension. Aggregating first (per id) and then looking names up joins
    the dimension (broadcast if its counted rows allow it) to at most one row
    per program, not to every fact.
    """
    per_id = fact.groupBy("program_id").agg(
        F.count(F.lit(1)).alias("schools"),
        rounded(avg_excluding_zero(F.col("in_state_tuition"))).alias("avg_in_state_tuition"))
    return per_id.join(broadcast_if_bounded(dim_program, CHECKED_BOUND), "program_id", "left").select(
        "program_id", "program_name", "schools", "avg_in_state_tuition")


def schools_of_types(fact: DataFrame, types: DataFrame) -> DataFrame:
    """Schools and zero-excluding average tuition by program type and state, for the given types only.

    ``types`` is a filtered dimension (bounded by its labels, broadcast if
    its counted rows allow it). A fact laid out by ``program_type_id`` is
    read in the folders of those types alone.
    """
    kept = fact.join(broadcast_if_bounded(types, CHECKED_BOUND), "program_type_id")
    return kept.groupBy("program_type", "state").agg(
        F.count(F.lit(1)).alias("schools"),
        rounded(avg_excluding_zero(F.col("in_state_tuition"))).alias("avg_in_state_tuition"))


def card_avg_credit_hours(courses: DataFrame) -> DataFrame:
    """Average over courses; ``n``, where present, says how many a row stands for."""
    n = F.col("n") if "n" in courses.columns else F.lit(1)
    hours = zero_as_null(F.col("credit_hours").cast("double"))
    return courses.agg(
        rounded(F.sum(hours * n) / F.sum(F.when(hours.isNotNull(), n))).alias("avg_credit_hours"),
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("courses"))


def top_departments(courses: DataFrame, n: int = 10) -> DataFrame:
    """Departments with the most courses; the limit is the report."""
    weight = F.col("n") if "n" in courses.columns else F.lit(1)
    counts = courses.groupBy("department").agg(F.sum(weight).cast("long").alias("courses"))
    order = [F.col("courses").desc(), F.col("department").asc()]
    return counts.orderBy(*order).limit(n).withColumn("position", small_row_number(order))


def levels_by_type(courses: DataFrame, fact: DataFrame) -> DataFrame:
    """Courses per (school type, program level).

    Courses are first counted per (school, level): that partial aggregate
    shrinks the big side before it meets the fact, which has one row per
    school.
    """
    per_school = courses.groupBy("school_id", "program_level").agg(F.count(F.lit(1)).alias("n"))
    joined = per_school.join(fact.select("school_id", "school_type"), "school_id")
    return joined.groupBy("school_type", "program_level").agg(F.sum("n").alias("courses"))


def course_detail(courses: DataFrame, fact: DataFrame) -> DataFrame:
    """Detail table: each course with its school's tuition and aid as display text."""
    school = fact.select("school_id", "name", "in_state_tuition", "financial_aid_percent")
    return courses.join(school, "school_id").select(
        "school_id", "name", "course_id", "course_name", "department", "credit_hours",
        F.col("tuition").alias("course_tuition"),
        display_whole(F.col("in_state_tuition")).alias("in_state_tuition_display"),
        display_percent(F.col("financial_aid_percent")).alias("financial_aid_display"))


def not_reported_display(fact: DataFrame) -> DataFrame:
    return fact.select(
        "school_id",
        display_whole(F.col("average_sat_score")).alias("sat_display"),
        display_whole(F.col("earnings_after_10yrs")).alias("earnings_display"),
        display_percent(F.col("graduation_rate")).alias("graduation_display"),
        display_percent(F.col("retention_rate")).alias("retention_display"))


def audit_zero_metrics(fact: DataFrame) -> DataFrame:
    """Zero (missing) count per metric, one row per metric."""
    wide = fact.agg(*[F.count_if(F.col(m) == 0).alias(m) for m in METRICS],
                    F.count(F.lit(1)).alias("_total"))
    return wide.unpivot("_total", METRICS, "metric", "zeros").select(
        "metric", "zeros", F.col("_total").alias("total"))


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: type name and non-null count (one pass, then unpivot)."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns],
                    F.count(F.lit(1)).alias("_rows"))
    long = counts.unpivot("_rows", df.columns, "column_name", "non_null")
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)],
        "column_name string, data_type string, ordinal int")
    return long.join(F.broadcast(types), "column_name").select(
        "ordinal", "column_name", "data_type", "non_null",
        (F.col("_rows") - F.col("non_null")).alias("nulls"))
