"""Hand-made edge rows (FIXTURES section 4) on tiny inline frames."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.functions import codes
from campuslens.functions.measures import selectivity_band, avg_excluding_zero
from campuslens.operators import dims as D
from campuslens.operators.decode import decode
from campuslens.operators.fill import fill_missing
from campuslens.operators.rank import RANK_KEYS, ranked_top_k
from campuslens.operators.upsert import (assert_source_unique, latest_per_key,
                                         upsert)
from campuslens.schemas import API_FIELDS
from campuslens.sources.pages import extract

RAW_SCHEMA = T.StructType([T.StructField(plain, t, True) for _, plain, t in API_FIELDS])


def raw_frame(spark, rows):
    full = [{f.name: r.get(f.name) for f in RAW_SCHEMA.fields} for r in rows]
    return spark.createDataFrame(full, RAW_SCHEMA)


def test_unmapped_codes_decode_to_default(spark):
    df = decode(raw_frame(spark, [{"school_id": i, "carnegie_basic": c}
                                  for i, c in enumerate([2, 34, -2])]))
    rows = df.select("program_name", "research_output").collect()
    assert {(r.program_name, r.research_output) for r in rows} == {("Unknown", 8)}


def test_null_code_decodes_to_default(spark):
    row = decode(raw_frame(spark, [{"school_id": 1}])).first()
    assert (row.school_type, row.program_name, row.program_type, row.duration, row.research_output) == \
        ("Unknown", "Unknown", "Unknown", "Unknown", 8)


def test_shared_label_gives_one_dimension_row(spark):
    df = decode(raw_frame(spark, [{"school_id": 1, "carnegie_undergrad": 1},
                                  {"school_id": 2, "carnegie_undergrad": 5}]))
    dim = D.build_dim(ranked_top_k(df), "program_type", "program_type_id").collect()
    assert [(r.program_type_id, r.program_type) for r in dim] == [(1, "higher part-time")]


def test_stray_space_label_kept_verbatim(spark):
    row = decode(raw_frame(spark, [{"school_id": 1, "carnegie_undergrad": 9}])).first()
    assert row.program_type == "medium full-time , selective, higher transfer-in"


@pytest.mark.parametrize("key,direction", RANK_KEYS[1:])
def test_null_sorts_last_within_tie_group(spark, key, direction):
    # Two schools equal on every earlier key; the one with a null on `key`
    # must rank after the one with a value, whatever the direction.
    base = {"carnegie_basic": 15}
    a = dict(base, school_id=1, **{key: None})
    b = dict(base, school_id=2, **{key: 5.0})
    ranked = ranked_top_k(decode(raw_frame(spark, [a, b]))).orderBy("rank").collect()
    assert [r.school_id for r in ranked] == [2, 1]


def test_fill_happens_after_the_cut(spark):
    # School 1 has a null faculty_quality and must be cut; filling first would
    # turn it into 0 and rank it first on the ascending key.
    rows = [{"school_id": 1, "faculty_quality": None},
            {"school_id": 2, "faculty_quality": 1.0},
            {"school_id": 3, "faculty_quality": 2.0}]
    out = fill_missing(ranked_top_k(decode(raw_frame(spark, rows)), 2)).collect()
    assert sorted(r.school_id for r in out) == [2, 3]
    rows = [{"school_id": 1, "faculty_quality": None}, {"school_id": 2, "faculty_quality": 1.0}]
    out = {r.school_id: r for r in fill_missing(ranked_top_k(decode(raw_frame(spark, rows)))).collect()}
    assert out[1].rank == 2 and out[1].faculty_quality == 0.0


def test_null_string_and_admission_fills(spark):
    row = fill_missing(ranked_top_k(decode(raw_frame(spark, [{"school_id": 1}])))).first()
    assert row.price_calculator == "0"
    assert row.admission_rate == 1.0
    assert row.average_sat_score == 0.0


def test_all_zero_group_average_is_null(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0)], "school_id long, sat double")
    assert df.agg(avg_excluding_zero(F.col("sat")).alias("a")).first().a is None


def test_rate_at_bound_is_highly_selective(spark):
    df = spark.createDataFrame([(0.10,), (0.1000001,), (None,)], "r double")
    got = [r.b for r in df.select(selectivity_band(F.col("r")).alias("b")).collect()]
    assert got == ["Highly Selective", "Very Selective", "Not Reported"]


def _write_lines(path, lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part-0.json").write_text("\n".join(json.dumps(x) for x in lines) + "\n")


def test_empty_pages_and_absent_keys(spark, tmp_path):
    _write_lines(tmp_path / "pages", [
        {"page": 1, "results": [{"id": 7, "school.name": "A"},
                                {"id": 8, "school.name": "B", "school.city": "X"}]},
        {"page": 2, "results": []},
        {"page": 3},
    ])
    rows = extract(spark, str(tmp_path / "pages")).orderBy("school_id").collect()
    assert [(r.school_id, r.city, r.page, r.pos) for r in rows] == [(7, None, 1, 0), (8, "X", 1, 1)]


def test_corrupt_page_fails_loudly(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    (d / "part-0.json").write_text('{"page": 1, "results": [{"id": 1}]}\n{"page": 2, "results": [\n')
    with pytest.raises(Exception):
        extract(spark, str(d)).collect()


def test_repeated_school_raises_or_keeps_latest(spark):
    src = spark.createDataFrame([(5, "old", 1, 3), (5, "new", 2, 0), (6, "x", 1, 4)],
                                "school_id long, name string, page long, pos long")
    with pytest.raises(ValueError):
        assert_source_unique(src, "school_id")
    kept = {r.school_id: r.name for r in latest_per_key(src, "school_id", ["page", "pos"]).collect()}
    assert kept == {5: "new", 6: "x"}


def test_quote_in_name_stored_unchanged(spark):
    stored = spark.createDataFrame([], "program_id int, program_name string")
    df = spark.createDataFrame([("O'Brien College", 1)], "program_name string, rank int")
    out = D.upsert_dim(stored, df, "program_name", "program_id").collect()
    assert [(r.program_id, r.program_name) for r in out] == [(1, "O'Brien College")]


def test_second_run_keeps_ids_and_appends_new_names(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "program_id int, program_name string")
    again = spark.createDataFrame([("b", 1), ("c", 2), ("a", 3), ("d", 4), ("c", 5)],
                                  "program_name string, rank int")
    out = {r.program_name: r.program_id for r in
           D.upsert_dim(stored, again, "program_name", "program_id").collect()}
    assert out == {"a": 1, "b": 2, "c": 3, "d": 4}


def test_upsert_updates_inserts_keeps_and_overwrites_with_null(spark):
    target = spark.createDataFrame([(1, 10.0, "t1"), (2, 20.0, "t2")], "k long, v double, s string")
    source = spark.createDataFrame([(2, None, "s2"), (3, 30.0, "s3"), (None, 40.0, "orphan")],
                                   "k long, v double, s string")
    out = sorted(upsert(target, source, "k").collect(), key=lambda r: (r.k is None, r.k))
    assert [(r.k, r.v, r.s) for r in out] == [(1, 10.0, "t1"), (2, None, "s2"), (3, 30.0, "s3"),
                                              (None, 40.0, "orphan")]


def test_upsert_partial_update_columns(spark):
    target = spark.createDataFrame([(1, 10.0, "t1")], "k long, v double, s string")
    source = spark.createDataFrame([(1, 11.0, "s1"), (2, 2.0, "s2")], "k long, v double, s string")
    out = {r.k: (r.v, r.s) for r in upsert(target, source, "k", update_cols=["v"]).collect()}
    assert out == {1: (11.0, "t1"), 2: (2.0, "s2")}


def test_code_tables_have_expected_sizes():
    assert len(codes.OWNERSHIP) == 3
    assert len(codes.RESEARCH_TIER) == 7
    assert len(codes.PROGRAM_TYPE) == 16 and len(set(codes.PROGRAM_TYPE.values())) == 15
    assert len(codes.DURATION) == 3
    assert len(codes.PROGRAM_NAME) == 33 and 2 not in codes.PROGRAM_NAME


@pytest.mark.parametrize("key", [k for k, _ in RANK_KEYS[1:]])
def test_nan_ranks_like_a_null(spark, tmp_path, key):
    """In the top-k and in the full load's order of first occurrence alike."""
    from campuslens.operators.rank import rank_key
    from campuslens.sources.pages import extract

    api = {plain: name for name, plain, _ in API_FIELDS}
    rows = [{"id": 1, api["carnegie_basic"]: 15, api[key]: float("nan")},
            {"id": 2, api["carnegie_basic"]: 15, api[key]: 5.0}, {"id": 3, api["carnegie_basic"]: 15}]
    _write_lines(tmp_path / "p", [{"page": 1, "results": rows}])
    df = decode(extract(spark, str(tmp_path / "p")))
    assert [r.school_id for r in ranked_top_k(df).orderBy("rank").collect()] == [2, 1, 3]
    assert [r.school_id for r in df.orderBy(rank_key()).collect()] == [2, 1, 3]
    assert df.where(F.isnan(F.col(key))).count() == 0


def test_unreported_admission_rate_is_not_open(spark):
    from campuslens.operators.fill import flag_reported
    from campuslens.plans import dashboard as DB

    raw = raw_frame(spark, [{"school_id": 1}, {"school_id": 2, "admission_rate": 1.0},
                            {"school_id": 3, "admission_rate": 0.0}, {"school_id": 4, "admission_rate": 0.5}])
    fact = fill_missing(flag_reported(decode(raw)))
    got = {r.school_id: (r.admission_rate, r.selectivity) for r in DB.retention_points(fact).collect()}
    assert got == {1: (1.0, "Not Reported"), 2: (1.0, "Open"), 3: (0.0, "Not Reported"), 4: (0.5, "Selective")}
    rows = {r.selectivity: r for r in DB.admission_summary(fact).collect()}
    assert rows["Not Reported"].avg_admission_rate is None and rows["Not Reported"].schools == 2
    assert rows["Open"].avg_admission_rate == 1.0


def test_appends_report_their_rows(spark, tmp_path):
    from campuslens.sources.tables import append_rows

    path = str(tmp_path / "t")
    assert [append_rows(spark.range(n), path) for n in (0, 7, 5)] == [0, 7, 5]
    assert spark.read.parquet(path).count() == 12


def test_null_keys_survive_keep_latest(spark):
    src = spark.createDataFrame([(None, "a", 1), (None, "b", 2), (1, "c", 1), (1, "d", 2)], "k long, v string, o long")
    assert sorted(r.v for r in latest_per_key(src, "k", ["o"]).collect()) == ["a", "b", "d"]


def test_rules_as_plain_values():
    """What the source fixes, written out: the oracle SQL shares the constants, this does not."""
    from campuslens.functions.measures import ABOVE_BANDS, SELECTIVITY_BANDS
    from campuslens.operators.fill import ADMISSION_RATE_FILL, ZERO_FILL_COLUMNS
    from campuslens.operators.rank import TOP_K

    assert RANK_KEYS == [("research_output", "asc"), ("admission_rate", "asc"), ("graduation_rate", "desc"),
                         ("earnings_after_10yrs", "desc"), ("faculty_quality", "asc"), ("international_outlook", "desc"),
                         ("revenue_per_student", "desc"), ("spending_per_student", "desc"), ("endowment", "desc")]
    assert TOP_K == 1000 and ADMISSION_RATE_FILL == 1.0 and ABOVE_BANDS == "Open"
    assert sorted(ZERO_FILL_COLUMNS) == sorted(
        ["price_calculator", "in_state_tuition", "out_of_state_tuition", "average_sat_score", "earnings_after_10yrs",
         "graduation_rate", "international_outlook", "revenue_per_student", "spending_per_student", "endowment",
         "retention_rate", "financial_aid_percent", "faculty_quality"])
    assert SELECTIVITY_BANDS == [(0.10, "Highly Selective"), (0.25, "Very Selective"), (0.50, "Selective"),
                                 (0.75, "Less Selective")]


def test_null_names_make_no_dimension_row(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3), ("a", 4)], "program_name string, rank int")
    assert sorted((r.program_id, r.program_name) for r in D.build_dim(df, "program_name", "program_id").collect()) == [
        (1, "a"), (2, "b")]
    assert D.first_occurrence(df, "program_name").count() == 3
    assert D.first_occurrence(D.drop_null_names(df, "program_name"), "program_name").count() == 2
