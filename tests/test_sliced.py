"""Slicers on every card and chart: the cube, bitmaps, SQL functions and run-time pruning."""

import pytest
from pyspark.sql import functions as F

from campuslens.plans import cube as CU
from campuslens.plans import dashboard as DB
from campuslens.plans import load as L
from campuslens.plans import sql_functions as SF
from campuslens.operators import rank as R
from campuslens.sources.standin import course
from campuslens.sources.tables import RepeatedKey, empty_clone, insert_rows, marked_repeats, store_partitioned, write_checked

from conftest import SF_SMALL, canonical

CHOICES = [{}, {"state": ["ASIA"]}, {"school_type": ["Public", "Unknown"]}, {"selectivity": ["Open"]},
           {"state": ["ASIA", "EUROPE"], "school_type": ["Public"]}, {"state": ["nowhere"]},
           {"state": ["ASIA"], "school_type": ["Public", "Unknown"], "selectivity": ["Open", "Selective"]}, {"state": []}]


def same(a, b):
    assert canonical(a.toPandas()) == canonical(b.toPandas())


@pytest.fixture(scope="module")
def schools(spark):
    return L.stage(L.filled_schools(spark, SF_SMALL), "schools")


@pytest.fixture(scope="module")
def cube(spark, schools):
    return L.stage(CU.measure_cube(schools), "cube")


def _sliced(schools, choice):
    bands = choice.get("selectivity")
    out = DB.slice_facts(schools, choice.get("state"), choice.get("school_type"))
    return out.where(DB.with_band(out)["selectivity"].isin(bands)) if bands else out


@pytest.mark.parametrize("choice", CHOICES, ids=str)
def test_every_chart_under_slicers_equals_the_chart_of_the_sliced_facts(schools, cube, choice):
    facts = schools
    for column, values in choice.items():
        if values:
            facts = DB.with_band(facts).where(F.col(column).isin(values)).drop("selectivity", "reported_rate")
    same(CU.graduation_by_type(cube, **choice), DB.graduation_by_type(facts))
    same(CU.retention_vs_selectivity(cube, **choice), DB.retention_vs_selectivity(facts))
    same(CU.selectivity_distribution(cube, **choice), DB.selectivity_distribution(facts))
    same(CU.admission_summary(cube, **choice), DB.admission_summary(facts))
    same(CU.cards(cube, **choice), DB.card_avg_tuition(facts).crossJoin(
        DB.card_total_schools(facts).select(F.col("rows").alias("schools"))))


def test_the_cube_is_one_aggregate_with_partial_values(schools, cube):
    plan = CU.measure_cube(schools)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" in plan and "partial_sum" in plan
    assert {r["level"] for r in cube.select("level").distinct().collect()} == set(range(8))
    with pytest.raises(ValueError):
        CU.cards(cube, city=["x"])


def test_null_labels_are_cells_of_their_own(spark):
    rows = [(None, "Public", 0.5, True, 1.0, 0.0), ("A", None, 0.0, True, 0.0, 3.0), (None, None, 0.7, False, 2.0, 5.0)]
    names = ["state", "school_type", "admission_rate", "admission_reported", "in_state_tuition", "out_of_state_tuition"]
    df = spark.createDataFrame(rows, "state string, school_type string, admission_rate double,"
                                     " admission_reported boolean, in_state_tuition double, out_of_state_tuition double")
    df = df.withColumns({c: F.lit(0.5) for c in ("graduation_rate", "retention_rate", "average_sat_score")})
    assert names == df.columns[:6]
    cube = CU.measure_cube(df)
    assert CU.cards(cube).first().schools == 3 and CU.cards(cube, state=["A"]).first().schools == 1
    same(CU.graduation_by_type(cube), DB.graduation_by_type(df))
    assert CU.cards(CU.measure_cube(df.limit(0))).first().schools == 0


def test_bitmaps_count_distinct_ids_exactly(spark):
    rows = [(i * 7919 % 100_000, f"s{i % 4}" if i % 9 else None, ["Public", "Unknown"][i % 2], i % 37, -(i % 5))
            for i in range(6000)] * 2
    rows += [(None, "s1", "Public", None, None), (-1, "s1", "Public", 0, 2 ** 31 - 1), (2 ** 40, "s1", "Public", 1, -2 ** 31),
             (0, "s2", "Public", 1, 0), (32767, "s2", "Public", 1, 0), (32768, "s2", "Public", 1, 0), (-32768, "s2", "Public", 1, 0)]
    df = spark.createDataFrame(rows, "school_id long, state string, school_type string, program_id int,"
                                     " program_type_id int").withColumn("admission_rate", F.lit(0.3))
    cube = L.stage(CU.distinct_cube(df), "distinct")
    counts = [F.count_distinct(column).alias(card) for card, column in CU.CARDS.items()]
    same(CU.distinct_cards(cube), df.agg(*counts))
    same(CU.distinct_cards(cube, ["state"]), df.groupBy("state").agg(*counts))
    same(CU.distinct_cards(cube, ["school_type"], state=["s1", "s2"]),
         df.where("state in ('s1', 's2')").groupBy("school_type").agg(*counts))
    assert CU.distinct_cards(CU.distinct_cube(df.limit(0))).first().total_universities == 0


@pytest.fixture(scope="module")
def functions(spark):
    ids, programs, _ = L.full_load_tables(spark, SF_SMALL, columns=["school_id", "state", "school_type", "in_state_tuition"])
    ids, programs = L.stage(ids, "ids"), L.stage(programs, "programs")
    courses = L.stage(course(spark, SF_SMALL), "courses")
    names = SF.register(spark, L.school(spark, SF_SMALL), ids, programs, courses, "t_")
    assert len(names) == 16
    return ids, programs, courses


STATES, TYPES = ["ASIA", "AFRICA"], ["Public", "Unknown"]
CALL = "states => array('ASIA', 'AFRICA'), school_types => array('Public', 'Unknown')"


@pytest.mark.parametrize("sliced", [False, True])
def test_every_function_equals_its_dataframe_form(spark, schools, functions, sliced):
    ids, programs, courses = functions
    args = CALL if sliced else ""
    cut = (lambda df: DB.slice_facts(df, STATES, TYPES)) if sliced else (lambda df: df)
    facts, own, records = cut(schools), cut(ids), cut(L.school(spark, SF_SMALL))
    kept = courses.join(facts.select("school_id"), "school_id", "left_semi")
    want = {"total_schools": DB.card_total_schools(facts), "avg_tuition": DB.card_avg_tuition(facts),
            "graduation_by_type": DB.graduation_by_type(facts), "retention_points": DB.retention_points(facts),
            "retention_vs_selectivity": DB.retention_vs_selectivity(facts),
            "selectivity_distribution": DB.selectivity_distribution(facts),
            "admission_summary": DB.admission_summary(facts), "not_reported_display": DB.not_reported_display(facts),
            "rank_schools": L.transform(records), "total_programs": DB.card_total_programs(own),
            "schools_by_program": DB.schools_by_program(own, programs),
            "avg_credit_hours": DB.card_avg_credit_hours(kept), "levels_by_type": DB.levels_by_type(courses, facts),
            "course_detail": DB.course_detail(courses, facts)}
    for name, df in want.items():
        got = spark.sql(f"SELECT * FROM t_{name}({args})")
        assert sorted(got.columns) == sorted(df.columns), name
        same(got, df)
    if not sliced:
        same(spark.sql("SELECT * FROM t_top_departments(3)"), DB.top_departments(courses, 3))
        for column, down in (("endowment", True), ("admission_rate", False), ("rank", True)):
            same(spark.sql(f"SELECT * FROM t_resort_ranking('{column}', {down}, 30)"),
                 R.resort(L.transform(records, 30), column, down))


def test_parameters(spark, functions):
    assert spark.sql("SELECT * FROM t_rank_schools(7)").count() == 7
    plan = spark.sql("SELECT * FROM t_rank_schools(7)")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan  # every partition keeps its best seven
    bands = spark.sql("SELECT * FROM t_selectivity_distribution(bounds => array(0.3D), labels => array('low'),"
                      " above => 'high')").collect()
    assert {r.selectivity for r in bands} == {"low", "high", "Not Reported"}
    spark.sparkContext.setLogLevel("OFF")
    with pytest.raises(Exception):
        spark.sql("SELECT * FROM t_resort_ranking('name')").collect()
    spark.sparkContext.setLogLevel("ERROR")
    some = SF.register(spark, L.school(spark, SF_SMALL), prefix="u_")
    assert "u_course_detail" not in some and "u_rank_schools" in some


def test_a_dimension_filter_prunes_the_facts_folders(spark):
    fact, _, types = L.full_load_tables(spark, SF_SMALL, columns=["state", "in_state_tuition"])
    stored, types = store_partitioned(L.stage(fact, "fact"), "program_type_id"), L.stage(types, "types")
    some = types.where(F.col("program_type").contains("selective"))
    df = DB.schools_of_types(stored, some)
    assert 0 < some.count() < types.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    same(df, DB.schools_of_types(fact, some))
    assert stored.count() == fact.count()


def test_a_checked_write_leaves_nothing_of_repeats(spark, tmp_path):
    rows = [(1, "a"), (2, "b"), (None, "c"), (None, "c"), (None, None)]
    df = spark.createDataFrame(rows, "id long, name string").repartition(3)
    assert write_checked(df, str(tmp_path / "one"), ["id"]) == 5
    assert spark.read.parquet(str(tmp_path / "one")).count() == 5
    with pytest.raises(RepeatedKey, match="'id': 1"):
        write_checked(df.unionByName(df.where("id = 2")), str(tmp_path / "two"), ["id"], ["name"])
    with pytest.raises(RepeatedKey, match="'name': 1"):  # two nulls of id, one name twice
        write_checked(df, str(tmp_path / "two"), ["id"], ["name"])
    assert not (tmp_path / "two").exists()
    assert write_checked(df.limit(0), str(tmp_path / "three"), ["id"], ["name"]) == 0
    hot = spark.range(3000).select((F.col("id") % 2 * F.col("id")).alias("id"), F.lit("x").alias("name"))
    assert marked_repeats(hot, ["id"], "again").where("again").count() == 1499
    # one job, and the keys' rows are not gathered
    plan = marked_repeats(hot, ["id"], "again")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_an_empty_clone_is_replaced_and_checks_what_is_inserted(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, `dotted.name` string, v double").schema
    first = empty_clone(spark, schema, "clone_of")
    insert_rows(spark.createDataFrame([(1.5, 7, "x")], "v double, id int, `dotted.name` string"), "clone_of")
    assert [tuple(r) for r in spark.table("clone_of").collect()] == [(7, "x", 1.5)]  # by name, widened
    for bad in ("BY NAME SELECT 'x' AS id, 'y' AS `dotted.name`, 1D AS v", "SELECT 1L, 'y'", "SELECT 1L, 'y', 1D, 2",
                "BY NAME SELECT 1L AS id, 'y' AS `dotted.name`, 1D AS v, 2 AS w"):
        with pytest.raises(Exception):
            spark.sql(f"INSERT INTO clone_of {bad}")
    for columns in ("id long, v double", "id long, `dotted.name` string, v double, w int"):
        with pytest.raises(ValueError):
            insert_rows(spark.createDataFrame([], columns), "clone_of")
    assert spark.table("clone_of").count() == 1
    assert empty_clone(spark, schema, "clone_of") != first and spark.table("clone_of").count() == 0
