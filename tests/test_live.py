"""The API as a stream and as records: resuming, replaying, and filters in the request."""

import json

import pytest
from pyspark.sql import functions as F

from campuslens.sources import api
from campuslens.sources.pages import land_pages, unnest_pages
from campuslens.streaming import incremental as I
from campuslens.streaming.latest import newest_records
from campuslens.operators.decode import flatten_record


@pytest.fixture()
def served(tmp_path):
    """Serve records 0..n-1 as pages of 100 under a base of 0 or 1; returns (url, serve)."""
    def serve(n, first=0, size=100, slices=None):
        for name, ids in (slices or {"all": range(n)}).items():
            (tmp_path / name).mkdir(exist_ok=True)
            ids = list(ids)
            for p in range(-(-len(ids) // size)):
                records = [{"id": i, "school.name": f"s{i}", "school.state": name if name != "all" else None,
                            "school.ownership": i % 3} for i in ids[p * size:(p + 1) * size]]
                (tmp_path / name / f"page-{first + p}.json").write_text(json.dumps({"results": records}))
    return f"file://{tmp_path}/all/page-{{page}}.json", serve


@pytest.mark.parametrize("first", [0, 1])
def test_a_restart_resumes_on_the_next_record(spark, tmp_path, served, first):
    url, serve = served
    run = lambda: sorted(tuple(r) for r in I.ingest_live(
        spark, url, str(tmp_path / "out"), str(tmp_path / "ck"), retries=0, pages_per_partition=2)
        .select("school_id", "page", "pos").collect())
    at = lambda n: [(i, first + i // 100, i % 100) for i in range(n)]
    for n in (250, 250, 251, 300, 300, 301, 930):  # also within a page, and exactly at its end
        serve(n, first)
        assert run() == at(n)


def test_nothing_there_yet(spark, tmp_path, served):
    url, serve = served
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    reader = api.SchoolPagesStreamReader({"url": url, "retries": "0"}, ["id"])
    serve(0)
    assert reader.latestOffset() == {"page": 1, "record": 0}
    serve(40, 1)
    assert reader.latestOffset() == {"page": 1, "record": 40}
    assert I.ingest_live(spark, url, out, ck, retries=0).count() == 40


@pytest.mark.parametrize("n", [1, 99, 100, 101, 799, 800, 801, 1234])
def test_the_end_is_found_by_few_requests(served, n):
    url, serve = served
    serve(n)
    reader = api.SchoolPagesStreamReader({"url": url, "retries": "0"}, ["id"])
    asked, ask = [], reader.requests._get
    reader.requests._get = lambda page: (asked.append(page), ask(page))[1]
    assert reader.latestOffset() == {"page": (n - 1) // 100, "record": (n - 1) % 100 + 1}
    assert len(asked) <= 12 and reader.initialOffset() == {"page": 0, "record": 0}


def test_a_replay_reads_the_same_records_and_notices_lost_ones(served):
    url, serve = served
    serve(230)
    reader = api.SchoolPagesStreamReader({"url": url, "retries": "0", "pages_per_partition": "2"}, ["id"])
    start, end = {"page": 0, "record": 30}, reader.latestOffset()

    def ids():
        return [row[0] for part in reader.partitions(start, end) for _, _, rows in reader.read(part) for row in rows]

    assert ids() == list(range(30, 230))
    serve(400)
    assert ids() == list(range(30, 230))  # the range's end, though the page has grown
    assert reader.partitions(end, end) == []
    serve(220)
    with pytest.raises(ValueError):
        ids()


def test_live_load_is_the_load_of_the_landed_pages(spark, tmp_path, served):
    url, serve = served
    for n in (120, 310):
        serve(n)
        live = I.run_live(spark, url, str(tmp_path / "state"), str(tmp_path / "ck"), k=80, retries=0)
    assert len(live.committed()) == 2
    got = {r.school_id for r in live.current("university").collect()}
    # both batches hold records equal but for their ids, so the smallest ids of each are the best
    assert got == set(range(80)) | set(range(120, 200))


def _pushed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_go_into_the_request(spark, tmp_path, served):
    _, serve = served
    serve(0, slices={"all": range(500), "CA": range(0, 500, 2), "NY": range(1, 400, 2), "N J": range(3)})
    url = f"file://{tmp_path}/{{state}}/page-{{page}}.json"
    df = api.read_records(spark, url, retries=0)
    assert df.count() == 500
    for states, n in ((["CA"], 250), (["CA", "NY"], 450), (["N J"], 3)):
        got = df.where(F.col("state").isin(states))
        assert got.count() == n and {r.state for r in got.collect()} == set(states)
        assert "Filter (" not in _pushed(got)  # nothing is left to Spark
    both = df.where((F.col("state") == "CA") & (F.col("ownership") == 1))
    assert both.count() == sum(i % 3 == 1 for i in range(0, 500, 2))
    assert "ownership" in _pushed(both).split("BatchScan")[0]  # this url cannot be asked by it
    for p in (tmp_path / "all").iterdir():  # only the chosen pages are fetched
        p.unlink()
    assert df.where("state = 'NY' AND state IN ('NY', 'CA') AND school_id < 100").count() == 50
    assert df.where("state = 'NY' AND state = 'CA'").count() == 0
    assert df.where(F.col("state") == F.lit(None).cast("string")).count() == 0


def test_an_http_request_takes_all_values_at_once():
    reader = api.SchoolRecordsReader({"url": "https://x.example/s?page={page}", "first_page": "0"}, ["id"])
    pushed = [api.In(("state",), ("CA", "NY")), api.EqualTo(("ownership",), 1), api.IsNotNull(("state",)),
              api.EqualTo(("name",), "x"), api.IsNotNull(("name",)), api.EqualTo(("level",), 2)]
    left = list(reader.pushFilters(pushed))
    assert left == [pushed[3], pushed[4]]
    assert reader._series() == [{"state": "CA,NY", "ownership": "1", "level": "2"}]
    reader.requests.chosen = reader._series()[0]
    assert reader.requests.page_url(4) == (
        "https://x.example/s?page=4&fields=id&per_page=100&school.state=CA%2CNY&school.ownership=1"
        "&school.institutional_characteristics.level=2")


def test_an_older_record_never_wins_over_a_newer_one(spark, tmp_path):
    def land(run, rows):
        raw = spark.createDataFrame([(None if i is None else i, v, p, n) for n, (i, v, p) in enumerate(rows)],
                                    "school_id long, name string, page long, pos long")
        empty = {plain: F.lit(None).cast(kind) for _, plain, kind in api.API_FIELDS if plain not in ("school_id", "name")}
        land_pages(raw.withColumns(empty), str(tmp_path / f"landing/run={run}"))

    table = {}

    def load(df, batch, query):
        for r in df.collect():
            table.setdefault(r.school_id, []).append((batch, r.run, r.name))

    def run():
        records = flatten_record(unnest_pages(I.landed(spark, str(tmp_path / "landing"), ["run"])))
        I.run_stream(newest_records(records, "school_id", ["run", "page", "pos"]), str(tmp_path / "ck"), load)

    land("b", [(1, "b1", 0), (2, "b2", 0), (1, "b1 again", 5), (None, "x", 0)])
    run()
    land("a", [(1, "a1", 9), (3, "a3", 0)])  # an older run, delivered late
    run()
    land("c", [(2, "c2", 0), (3, "c3", 0), (None, "y", 0)])
    land("bb", [(2, "bb2", 0)])  # both in one batch
    run()
    assert table == {1: [(0, "b", "b1 again")], 2: [(0, "b", "b2"), (2, "c", "c2")],
                     3: [(1, "a", "a3"), (2, "c", "c3")], None: [(0, "b", "x"), (2, "c", "y")]}


def test_newest_records_are_kept_by_the_engine(spark, tmp_path):
    """State by school costs no call into Python a school; what is delivered again does not pass again."""
    def land(run, rows):
        d = tmp_path / f"landing/run={run}"
        d.mkdir(parents=True, exist_ok=True)
        lines = [json.dumps({"page": p, "results": [{"id": i, "school.name": n} for i, n in of]}) for p, of in rows]
        (d / f"part-{len(list(d.iterdir()))}.json").write_text("\n".join(lines) + "\n")

    passed = []

    def run():
        records = flatten_record(unnest_pages(I.landed(spark, str(tmp_path / "landing"), ["run"])))
        newest = newest_records(records, "school_id", ["run", "page", "pos"])
        plan = newest._jdf.queryExecution().analyzed().toString()
        assert "Aggregate" in plan and "TransformWithState" not in plan
        passed.clear()
        I.run_stream(newest, str(tmp_path / "ck"), lambda df, batch, query: passed.extend(
            (r.school_id, r.run, r.page, r.pos, r.name) for r in df.collect()))
        return sorted(passed, key=str)

    land("b", [(3, [(1, "one"), (2, "two")]), (None, [(4, "no page")])])
    assert run() == [(1, "b", 3, 0, "one"), (2, "b", 3, 1, "two"), (4, "b", None, 0, "no page")]
    land("b", [(3, [(1, "one"), (2, "two"), (3, "three")]), (0, [(4, "four")]), (2, [(2, "old")])])
    assert run() == [(3, "b", 3, 2, "three"), (4, "b", 0, 0, "four")]
    land("b", [(None, [(4, "no page")]), (1, [(4, "five"), (1, "old")])])
    assert run() == [(4, "b", 1, 0, "five")]
    assert run() == []
