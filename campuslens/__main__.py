"""Command line: the scheduled load and the dashboard refresh.

    python -m campuslens load --landing DIR --state DIR [--k 1000]
    python -m campuslens load --api-url URL --landing DIR --state DIR
    python -m campuslens load --api-url URL --live --state DIR
    python -m campuslens dashboard --state DIR --out DIR [--courses PATH] [--state-slicer CA ...]

``load`` ingests every page landed under ``--landing`` since the last run
(an available-now stream with its checkpoint under ``--state``). It ranks
the new records, keeps the top k, fills, upserts the dimensions and upserts
the fact, writing new table versions. With ``--api-url`` (a ``{page}``
template), the pages are first fetched page-parallel and landed as they come
as one new ``run=`` folder; with ``--live`` as well, the records that the API
has added since the last run are loaded without landing them. Several runs
landed since the last load are loaded together. Under spark-submit, the submitter's master and settings
hold, and ``spark.checkpoint.dir`` must name a shared folder.

``dashboard`` reads the current tables and writes one parquet
table per dashboard question under ``--out``. Slicers (``--state-slicer``,
``--type-slicer``, each may be repeated) hold for every question; the cards and
charts come from the measure cube. The course questions need a
course table (``--courses``, parquet with school_id, course_id,
course_name, department, program_level, credit_hours, tuition).
"""

from __future__ import annotations

import argparse
import time
import uuid


def run_label() -> str:
    """A run's label: UTC time, so labels sort in load order, and a unique suffix."""
    return f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"


def _load(spark, args) -> None:
    from campuslens.sources.api import land_api
    from campuslens.streaming.incremental import run_available, run_live

    options = dict(o.split("=", 1) for o in args.api_option) if args.api_url else {}
    state = args.state.rstrip("/")
    repeats = "latest" if args.keep_latest else "raise"
    if args.live:
        tables = run_live(spark, args.api_url, f"{state}/tables", f"{state}/live", k=args.k, on_repeat=repeats, **options)
    else:
        if args.api_url:
            land_api(spark, args.api_url, f"{args.landing}/run={run_label()}", **options)
        tables = run_available(spark, args.landing, f"{state}/tables", f"{state}/stream",
                               ["run"], k=args.k, on_repeat=repeats)
    if args.keep_versions:
        tables.expire(args.keep_versions)
    print(f"committed versions: {tables.committed()}")


def _dashboard(spark, args) -> None:
    from campuslens.plans import cube as CU
    from campuslens.plans import dashboard as DB
    from campuslens.session import stage
    from campuslens.streaming.incremental import StoredTables

    tables = StoredTables(spark, f"{args.state.rstrip('/')}/tables")
    done = tables.loads()
    every = tables.current("university", done)
    slicers = {"state": args.state_slicer, "school_type": args.type_slicer}
    fact = DB.slice_facts(every, args.state_slicer, args.type_slicer)
    cube = stage(CU.measure_cube(every), "cube")
    outputs = {
        "schools_by_program": DB.schools_by_program(fact, tables.current("dim_program", done)),
        "card_total_schools": DB.card_total_schools(fact),
        "card_avg_tuition": CU.cards(cube, **slicers).drop("schools"),
        "graduation_by_type": CU.graduation_by_type(cube, **slicers),
        "retention_vs_selectivity": CU.retention_vs_selectivity(cube, **slicers),
        "retention_points": DB.retention_points(fact),
        "selectivity_distribution": CU.selectivity_distribution(cube, **slicers),
        "admission_summary": CU.admission_summary(cube, **slicers),
        "card_total_programs": DB.card_total_programs(fact),
        "not_reported_display": DB.not_reported_display(fact),
        "audit_zero_metrics": DB.audit_zero_metrics(fact),
    }
    if args.courses:
        courses = spark.read.parquet(args.courses)
        if args.state_slicer or args.type_slicer:
            courses = courses.join(fact.select("school_id"), "school_id", "left_semi")
        outputs.update({
            "card_avg_credit_hours": DB.card_avg_credit_hours(courses),
            "top_departments": DB.top_departments(courses),
            "levels_by_type": DB.levels_by_type(courses, fact),
            "course_detail": DB.course_detail(courses, fact),
        })
    for name, df in outputs.items():
        df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
    print(f"wrote {len(outputs)} dashboard tables to {args.out}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="campuslens")
    sub = parser.add_subparsers(dest="command", required=True)
    load = sub.add_parser("load", help="ingest newly landed pages into the tables")
    load.add_argument("--landing", help="where pages are landed (not needed with --live)")
    load.add_argument("--state", required=True)
    load.add_argument("--api-url")
    load.add_argument("--live", action="store_true", help="load what the API has added, without landing it")
    load.add_argument("--api-option", action="append", default=[], metavar="NAME=VALUE",
                      help="option of the page reader (fields, per_page, api_key, retries, ...)")
    load.add_argument("--k", type=int, default=1000)
    load.add_argument("--keep-versions", type=int, default=0,
                      help="delete files that only older commits than this many refer to")
    load.add_argument("--keep-latest", action="store_true",
                      help="a school landed twice keeps its latest record instead of failing the load")
    dash = sub.add_parser("dashboard", help="write the dashboard tables")
    dash.add_argument("--state", required=True)
    dash.add_argument("--out", required=True)
    dash.add_argument("--courses")
    dash.add_argument("--state-slicer", action="append", default=[], metavar="STATE")
    dash.add_argument("--type-slicer", action="append", default=[], metavar="TYPE")
    for command in (load, dash):
        command.add_argument("--input-gb", type=float, help="size partitions for a run over this much data")
    args = parser.parse_args(argv)
    if args.command == "load" and not (args.landing or (args.live and args.api_url)):
        parser.error("load needs --landing, or --live with --api-url")

    from campuslens.session import get_session

    spark = get_session(input_bytes=int(args.input_gb * 2 ** 30) if args.input_gb else None)
    try:
        (_load if args.command == "load" else _dashboard)(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
