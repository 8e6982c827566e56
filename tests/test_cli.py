"""The command-line flows, driven in-process with the test session."""

from argparse import Namespace

from campuslens.__main__ import _dashboard, _load
from campuslens.plans import load as L
from campuslens.session import scratch_path
from campuslens.sources import pages as PG
from campuslens.sources.standin import course, school_raw, serve_api

from conftest import SF_SMALL


def test_two_scheduled_loads_then_dashboard(spark):
    root = scratch_path(spark, "cli")
    args = Namespace(landing=f"{root}/landing", state=f"{root}/state", api_url=None, k=1000, keep_latest=False,
                     keep_versions=1, live=False)
    for run in ("earlier", "later"):
        PG.land_pages(school_raw(spark, SF_SMALL, **L.run_window(run)), f"{args.landing}/run={run}")
        _load(spark, args)
    courses = f"{root}/courses"
    course(spark, SF_SMALL).write.parquet(courses)
    _dashboard(spark, Namespace(state=args.state, out=f"{root}/dash", courses=courses, state_slicer=[],
                                type_slicer=[]))
    total = spark.read.parquet(f"{root}/dash/card_total_schools").first()
    expected = L.load_university(spark, SF_SMALL)
    assert total.total_universities == expected.count()
    assert spark.read.parquet(f"{root}/dash/top_departments").count() == 10
    programs = spark.read.parquet(f"{root}/dash/schools_by_program")
    assert programs.where("program_name IS NULL").count() == 0
    assert programs.agg({"schools": "sum"}).first()[0] == expected.count()

    # sliced, every question is that of the schools chosen
    _dashboard(spark, Namespace(state=args.state, out=f"{root}/sliced", courses=courses, state_slicer=["ASIA", "EUROPE"],
                                type_slicer=["Public"]))
    some = expected.where("state IN ('ASIA', 'EUROPE') AND school_type = 'Public'")
    read = lambda name: spark.read.parquet(f"{root}/sliced/{name}")
    assert read("card_total_schools").first().total_universities == some.count()
    assert read("selectivity_distribution").agg({"schools": "sum"}).first()[0] == some.count()
    assert [r.school_type for r in read("graduation_by_type").collect()] == ["Public"]
    assert {r.school_type for r in read("levels_by_type").select("school_type").collect()} <= {"Public"}


def test_live_loads_need_no_landing(spark):
    root = scratch_path(spark, "cli-live")
    raw = school_raw(spark, SF_SMALL)
    args = Namespace(landing=None, state=f"{root}/state", api_option=["retries=0"], live=True, k=1000,
                     keep_latest=False, keep_versions=0)
    from campuslens.streaming.incremental import StoredTables

    for n in (60, 150):
        args.api_url = serve_api(raw.where(f"school_id < {n}"), f"{root}/api") + "/all/page-{page}.json"
        _load(spark, args)
        tables = StoredTables(spark, f"{root}/state/tables")
        assert tables.current("university").count() == raw.where(f"school_id < {n}").count()
    assert tables.committed() == [0, 1]
