"""Bindings of the school and course records to the driver's tables.

The real records arrive as landed API pages. For tests and benchmarks the
same shape is derived from ``customer``, ``orders``, ``nation`` and
``region`` (one school per customer) and from ``lineitem``, ``orders`` and
``part`` (courses). The derivations are chosen so that every sort key, null
order and fill decision of the ranking is visible in the result.

Plan shape: ``orders`` is aggregated per customer with a partial (map-side)
aggregate before the shuffle, so a customer holding a third of all orders
costs one partial row per input partition, not a third of the shuffle. The
customer side then joins the aggregate on the same key; ``nation`` and
``region`` are fixed-size tables that the planner broadcasts from their
file statistics.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslens.functions.ids import global_position
from campuslens.schemas import API_FIELDS
from campuslens.session import session_key, table

# Two loads: orders before 1997 and from 1997 on, so that together they read
# every order. Customers with no order in a window are not reported by that
# run. The earlier run comes from an older release of the classifications,
# which ends at these codes: later ones are not assigned yet (null).
EARLIER_RUN = (None, "1997-01-01")
LATER_RUN = ("1997-01-01", None)
EARLIER_LAST_BASIC, EARLIER_LAST_UNDERGRAD = 17, 6


def _count_nonzero(cond):
    return F.nullif(F.count_if(cond), F.lit(0))


_PLANS: dict = {}


def school_raw(spark: SparkSession, sf_dir: str, since: str | None = None,
               until: str | None = None, reported_only: bool = False,
               old_codes: bool = False) -> DataFrame:
    """Raw school records (codes not yet decoded) with their page ordinals.

    ``since``/``until`` restrict the orders to a date window; with
    ``reported_only`` a school without orders in the window is left out, with
    ``old_codes`` classification codes beyond the older release are null.
    The lazy plan (not its data) is built once per session and arguments:
    DataFrames are immutable, and building this one costs thousands of
    driver round trips.
    """
    key = (session_key(spark), sf_dir.rstrip("/"), since, until, reported_only, old_codes)
    if key not in _PLANS:
        _PLANS[key] = _school_raw(spark, sf_dir, since, until, reported_only, old_codes)
    return _PLANS[key]


def _school_raw(spark: SparkSession, sf_dir: str, since: str | None,
                until: str | None, reported_only: bool, old_codes: bool) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")
    # Cutoffs take the column's own type (timestamp without time zone in the
    # driver's files), so the window does not move with the session time zone.
    date_type = orders.schema["o_orderdate"].dataType
    if since is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(since).cast(date_type))
    if until is not None:
        orders = orders.where(F.col("o_orderdate") < F.lit(until).cast(date_type))

    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    per_school = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        _count_nonzero(status == "F").alias("n_f"),
        _count_nonzero(status == "O").alias("n_o"),
        _count_nonzero(priority == "1-URGENT").alias("n_urgent"),
        _count_nonzero(priority == "5-LOW").alias("n_low"),
        F.min(price).alias("price_min"),
        F.max(price).alias("price_max"),
        F.max(F.when(priority == "1-URGENT", price)).alias("urgent_max"),
        F.max(F.when(status == "P", price)).alias("pending_max"),
        F.min(F.when(status == "F", price)).alias("finished_min"),
    )

    joined = (customer
              .join(per_school, F.col("c_custkey") == F.col("o_custkey"),
                    "inner" if reported_only else "left")
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
              .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))

    key = F.col("c_custkey")
    n = F.col("n").cast("double")

    def share(count_col):
        return F.col(count_col).cast("double") / n

    def quarter_steps(count_col, cap=None):
        steps = F.floor(share(count_col) * 4)
        if cap is not None:
            steps = F.least(steps, F.lit(cap))
        return F.nullif(steps, F.lit(0)).cast("double") / 4

    def coarse(c, step):
        return F.floor(c / step).cast("double") * step

    def null_when(cond, value):
        return F.when(~cond, value)

    def assigned(code, last):
        return F.when(code <= last, code) if old_codes else code

    return joined.select(
        key.alias("school_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        null_when(key % 11 == 0, (key % 5).cast("int")).alias("ownership"),
        F.concat(F.lit("http://school.example/"), key.cast("string")).alias("school_url"),
        null_when(key % 4 == 0,
                  F.concat(F.lit("http://calc.example/"), key.cast("string"))).alias("price_calculator"),
        assigned((key % 37 - 2).cast("int"), EARLIER_LAST_BASIC).alias("carnegie_basic"),
        assigned((key % 18 - 1).cast("int"), EARLIER_LAST_UNDERGRAD).alias("carnegie_undergrad"),
        (key % 4).cast("int").alias("level"),
        (F.when(key % 9 == 0, F.lit(0.1))
          .when(key % 9 == 1, F.lit(0.05))
          .when(key % 9 == 2, F.lit(1.0))
          .otherwise(quarter_steps("n_f", cap=3))).cast("double").alias("admission_rate"),
        null_when(key % 3 == 0, (F.lit(400) + (key * 37) % 1201).cast("double")).alias("average_sat_score"),
        F.col("price_min").alias("in_state_tuition"),
        F.col("price_max").alias("out_of_state_tuition"),
        coarse(F.col("urgent_max"), 250000).alias("earnings_after_10yrs"),
        quarter_steps("n_o").alias("graduation_rate"),
        null_when(key % 7 == 0, (key % 3).cast("double")).alias("faculty_quality"),
        null_when(F.col("c_nationkey") % 4 == 0,
                  (F.col("c_nationkey") % 4).cast("double") / 4).alias("international_outlook"),
        share("n_urgent").alias("retention_rate"),
        null_when(key % 13 == 0, coarse(F.col("c_acctbal"), 4000)).alias("revenue_per_student"),
        coarse(F.col("pending_max"), 250000).alias("spending_per_student"),
        null_when(key % 5 == 0, F.col("finished_min")).alias("endowment"),
        share("n_low").alias("financial_aid_percent"),
        F.floor(key / 100).alias("page"),
        (key % 100).alias("pos"),
    )


def _offered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (school, course) pairs: ``lineitem ⨝ orders``."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("school_id"), F.col("l_partkey").alias("course_id"))
            .distinct())


def course_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per course offered: its department, credit hours and ``n`` schools.

    Counted per course before ``part`` is met, so that join has one row a
    course on either side.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    counts = _offered(spark, sf_dir).groupBy("course_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(part, F.col("course_id") == F.col("p_partkey")).select(
        "course_id", F.col("p_brand").alias("department"), F.col("p_size").alias("credit_hours"), "n")


def course(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct courses per school: ``lineitem ⨝ orders ⨝ part``.

    The distinct is taken on ``(school, part)`` *before* joining ``part``:
    every course attribute depends on the part key alone, so the result is
    the same and the part join sees one row per course instead of one per
    line item. Both steps pre-aggregate map-side before their shuffle.
    """
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return _offered(spark, sf_dir).join(part, F.col("course_id") == F.col("p_partkey")).select(
        "school_id",
        "course_id",
        F.col("p_name").alias("course_name"),
        F.col("p_brand").alias("department"),
        F.col("p_type").alias("program_level"),
        F.col("p_size").alias("credit_hours"),
        F.col("p_retailprice").alias("tuition"),
    )


PAGE_RECORDS = 100


def _write_bodies(folder: str):
    def write(rows):
        for row in rows:
            path = os.path.join(folder, row["slice"], f"page-{row['page']}.json")
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(f"{path}.{os.getpid()}", "w", encoding="utf-8") as f:
                f.write(row["body"])
            os.replace(f.name, path)  # a retried task leaves the same page
    return write


def serve_api(raw: DataFrame, folder: str, by: str | None = None) -> str:
    """Lay ``raw`` records out as the API answers them: a file a page, 100 records a page, by school_id.

    Under ``all`` lies the whole sequence; with ``by`` also, under each value
    of that column (few labels), the sequence of its records. The folder must
    be one that the driver and all executors share as a file system, since
    the url ``file://<folder>/...`` stands in for the API. Returns the url.
    """
    folder = folder.removeprefix("file://").removeprefix("file:")
    if "://" in folder:
        raise ValueError("the stand-in for the API needs a shared folder with a file path")
    whole = global_position(raw.drop("page", "pos"), [F.col("school_id")], "place").withColumn("slice", F.lit("all"))
    parts = [whole]
    if by is not None:
        named = global_position(raw.drop("page", "pos").where(F.col(by).isNotNull()),
                                [F.col(by), F.col("school_id")], "place")
        first = named.groupBy(F.col(by).alias("slice")).agg(F.min("place").alias("first"))  # a row a label
        parts.append(named.join(F.broadcast(first), F.col(by) == F.col("slice"))
                     .withColumn("place", F.col("place") - F.col("first") + 1).drop("first"))
    record = F.struct(*[F.col(plain).alias(key) for key, plain, _ in API_FIELDS])
    for part in parts:
        (part.select("slice", F.floor((F.col("place") - 1) / PAGE_RECORDS).alias("page"), "place", record.alias("record"))
         .groupBy("slice", "page")
         .agg(F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(F.struct("place", "record"))),
                                             lambda e: e["record"]).alias("results"))).alias("body"))
         .foreachPartition(_write_bodies(folder)))
    return f"file://{folder}"
