"""Algebraic properties of the operators."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from campuslens.functions.ids import global_position
from campuslens.operators import dims as D
from campuslens.operators.rank import rank_order, ranked_top_k, top_k
from campuslens.operators.upsert import upsert
from campuslens.plans import load as L

from conftest import SF_SMALL

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _keys(rows):
    return sorted(tuple(r) for r in rows)


def test_upsert_twice_equals_once(spark):
    target = L.full_load(spark, SF_SMALL, "earlier")
    source = L.full_load(spark, SF_SMALL, "later")
    once = upsert(target, source, "school_id")
    twice = upsert(once, source, "school_id")
    assert _keys(once.collect()) == _keys(twice.collect())


def test_ids_stable_when_names_reupserted(spark):
    stored, dp, dt, later = L.two_run_state(spark, SF_SMALL)
    up = D.upsert_dim(dp, later, "program_name", "program_id")
    again = D.upsert_dim(up, later, "program_name", "program_id")
    assert _keys(up.collect()) == _keys(again.collect())
    before = dict((r.program_name, r.program_id) for r in dp.collect())
    after = dict((r.program_name, r.program_id) for r in up.collect())
    assert all(after[n] == i for n, i in before.items())


def test_rank_is_gap_free(spark):
    ranks = sorted(r["rank"] for r in L.top(spark, SF_SMALL).select("rank").collect())
    assert ranks == list(range(1, len(ranks) + 1))


def test_global_position_equals_row_number(spark):
    school = L.school(spark, SF_SMALL).repartition(7)
    got = {r.school_id: r.pos for r in global_position(school, rank_order(), "pos")
           .select("school_id", "pos").collect()}
    want = {r.school_id: r.rn for r in ranked_top_k(school, 10**6, "rn").select("school_id", "rn").collect()}
    assert got == want


@SETTINGS
@given(k=st.integers(min_value=1, max_value=60), split=st.integers(min_value=0, max_value=149))
def test_topk_of_union_is_topk_of_topks(spark, k, split):
    school = L.school(spark, SF_SMALL)
    a = school.where(F.col("school_id") <= split)
    b = school.where(F.col("school_id") > split)
    direct = top_k(school, k).select("school_id").collect()
    merged = top_k(top_k(a, k).unionByName(top_k(b, k)), k).select("school_id").collect()
    assert _keys(direct) == _keys(merged)


_ROW = st.tuples(st.one_of(st.none(), st.integers(0, 12)),
                 st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
                 st.one_of(st.none(), st.sampled_from(["a", "b", "c"])))


def _model_upsert(target, source, update_cols):
    """Plain-Python merge: match on non-null key, update listed columns, insert, keep."""
    by_key = {}
    out = []
    for row in target:
        if row[0] is None:
            out.append(row)
        else:
            by_key[row[0]] = list(row)
    for row in source:
        if row[0] is None:
            out.append(row)
        elif row[0] in by_key:
            cur = by_key[row[0]]
            for i, name in ((1, "v"), (2, "s")):
                if name in update_cols:
                    cur[i] = row[i]
        else:
            by_key[row[0]] = list(row)
    return sorted([tuple(r) for r in by_key.values()] + out, key=repr)


@SETTINGS
@given(target=st.lists(_ROW, max_size=12, unique_by=lambda r: r[0] if r[0] is not None else object()),
       source=st.lists(_ROW, max_size=12, unique_by=lambda r: r[0] if r[0] is not None else object()),
       update_cols=st.sampled_from([["v", "s"], ["v"], ["s"]]))
def test_upsert_matches_a_plain_merge_model(spark, target, source, update_cols):
    schema = "k long, v double, s string"
    t = spark.createDataFrame(target, schema)
    s = spark.createDataFrame(source, schema)
    got = sorted([tuple(r) for r in upsert(t, s, "k", update_cols).collect()], key=repr)
    assert got == _model_upsert(target, source, update_cols)
    bounded = sorted([tuple(r) for r in upsert(t, s, "k", update_cols, source_rows_bound=12).collect()],
                     key=repr)
    assert bounded == got


def test_hot_key_holding_a_third_of_rows(spark):
    """Aggregating operators stay exact when one key holds a third of all rows."""
    from campuslens.operators.upsert import check_source_unique, latest_per_key

    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).cast("long").alias("k"),
        (F.col("id") % 10).cast("long").alias("page"),
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("cold")).alias("label"),
        F.col("id").cast("int").alias("rank")).repartition(8)
    latest = {r.k: r.pos for r in latest_per_key(df, "k", ["page", "pos"]).collect()}
    # latest by (page, pos): the hot rows' best page is 9, and 2979 is the
    # largest multiple of 3 below n that ends in 9
    assert latest[-1] == 2979 and len(latest) == 1 + (n - n // 3)
    summary = check_source_unique(df, "k").first()
    assert (summary.rows, summary.repeated_keys, summary.null_key_rows) == (n, 1, 0)
    firsts = {r.label: r.first_rank for r in D.first_occurrence(df, "label").collect()}
    assert firsts == {"hot": 0, "cold": 1}


def test_global_position_on_many_partitions_keeps_every_row(spark):
    """Regression: positions over a multi-partition sort cover 1..n exactly."""
    n = 200_000
    df = spark.range(n).select(F.col("id"), ((F.col("id") * 7919) % 200_003).alias("v")).repartition(16)
    out = global_position(df, [F.col("v").asc(), F.col("id").asc()], "pos").toPandas()
    assert len(out) == n
    assert sorted(out["pos"]) == list(range(1, n + 1))
    ordered = out.sort_values("v")
    assert list(ordered["pos"]) == list(range(1, n + 1))
