"""Physical plan shapes."""

import re

from pyspark.sql import functions as F

from campuslens.operators.rank import top_k
from campuslens.plans import dashboard as DB
from campuslens.plans import load as L
from campuslens.schemas import FACT_COLUMNS
from campuslens.sources.standin import course

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(top_k(L.school(spark, SF_SMALL)))


def test_id_attach_is_broadcast(spark):
    top = L.top(spark, SF_SMALL)
    p = plan(L.fact(top))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p


def test_slicer_is_pushed_to_parquet(spark):
    fact = L.stage(L.full_load(spark, SF_SMALL), "fact")
    sliced = DB.slice_facts(fact, ["AMERICA"], ["Public"]).select("school_id")
    p = plan(sliced)
    assert "PushedFilters" in p and "AMERICA" in p
    # Column pruning: only the projected and filtered columns are read.
    assert "ReadSchema: struct<school_id:bigint,state:string,school_type:string>" in p


def test_registered_slicer_reads_a_stored_fact(spark):
    from campuslens.plans.catalog import QUERIES

    p = plan(QUERIES["slice_state_type"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^]]*(In|Or)\(", p) and "university" in p


def test_course_distinct_runs_before_part_join(spark):
    text = course(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # the Aggregate (distinct) sits below the join with part
    assert text.index("Join") < text.index("Aggregate")


def test_orders_aggregate_is_partial_before_shuffle(spark):
    p = plan(L.school(spark, SF_SMALL))
    assert "partial_count" in p and "partial_min" in p


def test_full_update_upsert_is_an_anti_join(spark):
    from campuslens.operators.upsert import upsert

    t = L.stage(L.full_load(spark, SF_SMALL, "earlier"), "t")
    s = L.stage(L.full_load(spark, SF_SMALL, "later"), "s")
    p = plan(upsert(t, s, "school_id"))
    assert "LeftAnti" in p and "FullOuter" not in p
    partial = plan(upsert(t, s, "school_id", update_cols=["name"]))
    assert partial.count("FullOuter") == 1


def test_bounded_source_upsert_never_shuffles_the_target(spark):
    from campuslens.operators.upsert import upsert

    t = L.stage(L.full_load(spark, SF_SMALL, "earlier").select(*FACT_COLUMNS), "t")
    s = L.stage(L.fact(L.top(spark, SF_SMALL, "later", 50)), "s")
    p = plan(upsert(t, s, "school_id", source_rows_bound=50))
    assert re.search(r"BroadcastHashJoin \[[^]]*\], \[[^]]*\], LeftAnti", p)
    assert "Exchange hashpartitioning" not in p
    # a bound beyond the limit is no licence to broadcast; the rows are the same
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = upsert(t, s, "school_id", source_rows_bound=10 ** 9)
        assert "SortMergeJoin" in plan(beyond) and "BroadcastHashJoin" not in plan(beyond)
        assert sorted(map(str, beyond.collect())) == sorted(map(str, upsert(t, s, "school_id", source_rows_bound=50).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measures_are_partial_aggregates(spark):
    fact = L.full_load(spark, SF_SMALL)
    p = plan(DB.graduation_by_type(fact).where(F.lit(True)))
    assert "partial_avg" in p


BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def test_no_query_plans_a_cross_join_or_python_udf(spark):
    """Every registered query stays JVM-side and joins only on keys."""
    from campuslens.plans.catalog import QUERIES

    offenders = {}
    for name, fn in QUERIES.items():
        text = plan(fn(spark, SF_SMALL))
        found = [b for b in BANNED if b in text]
        if found:
            offenders[name] = found
    assert offenders == {}


def test_bucketed_target_is_not_shuffled(spark):
    from campuslens.operators.upsert import upsert
    from campuslens.sources.tables import store_bucketed

    stored = store_bucketed(L.full_load(spark, SF_SMALL, "earlier"), "university", "school_id", 4)
    source = L.stage(L.full_load(spark, SF_SMALL, "later"), "s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(upsert(stored, source, "school_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in p
    assert p.count("Exchange hashpartitioning") == 1   # the source keys only


def test_flagship_scans_read_only_needed_columns(spark):
    p = plan(L.top(spark, SF_SMALL))
    assert ("ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double,"
            "o_orderpriority:string>") in p
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double>" in p
    assert "o_orderdate" not in p   # the whole-run flagship has no date window


def test_size_checked_broadcast_falls_back_beyond_its_bound(spark):
    from campuslens.functions.joins import broadcast_if_bounded

    facts = spark.range(100).select((F.col("id") % 5).alias("k"), F.col("id"))
    dim = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        within = plan(facts.join(broadcast_if_bounded(dim, 10), "k", "left"))
        beyond = plan(facts.join(broadcast_if_bounded(dim, 3), "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in within
    assert "BroadcastHashJoin" not in beyond and "SortMergeJoin" in beyond


def test_measures_read_pruned_columns_and_stage_nothing(spark, monkeypatch):
    """The registered dashboard queries without ids are lazy over the source."""
    from campuslens import session
    from campuslens.plans.catalog import QUERIES

    def refuse(*a, **k):
        raise AssertionError("staged")

    monkeypatch.setattr(L, "stage", refuse)
    wanted = {"graduation_by_type": ("o_orderstatus", ["o_totalprice", "c_name", "o_orderpriority"]),
              "card_avg_tuition": ("o_totalprice", ["o_orderstatus", "c_name", "c_acctbal"]),
              "selectivity_distribution": ("o_orderstatus", ["o_totalprice", "c_name"])}
    for name, (read, unread) in wanted.items():
        p = plan(QUERIES[name](spark, SF_SMALL))
        schemas = " ".join(re.findall(r"ReadSchema: struct<[^>]*>", p))
        assert read in schemas and not [c for c in unread if c in schemas], (name, schemas)
    for name in ("avg_excluding_zero", "not_reported_display", "retention_points", "audit_zero_metrics",
                 "card_total_schools", "retention_vs_selectivity", "admission_summary", "levels_by_type", "course_detail"):
        QUERIES[name](spark, SF_SMALL)
    assert session.stage is not refuse


def test_numbering_beyond_one_task_gives_the_same_ranks(spark, monkeypatch):
    from campuslens.operators import rank as R

    rows = L.school(spark, SF_SMALL)
    one = sorted((r["school_id"], r["rank"]) for r in R.ranked_top_k(rows, 100).collect())
    again = sorted((r["school_id"], r["position"]) for r in R.resort(R.ranked_top_k(rows, 100), "endowment").collect())
    monkeypatch.setattr(R, "ONE_TASK_ROWS", 10)
    spread = R.ranked_top_k(rows, 100)
    assert sorted((r["school_id"], r["rank"]) for r in spread.collect()) == one
    assert sorted((r["school_id"], r["position"]) for r in R.resort(spread, "endowment", k=100).collect()) == again
