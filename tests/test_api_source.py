"""The page-parallel API source, driven through file:// URLs (no network here)."""

import json

import pytest

from campuslens.sources.api import fetch_json, read_api


def _land(tmp_path, pages, total):
    for n, records in pages.items():
        doc = {"metadata": {"total": total, "per_page": 100, "page": n}, "results": records}
        (tmp_path / f"page-{n}.json").write_text(json.dumps(doc))
    return "file://" + str(tmp_path) + "/page-{page}.json"


def test_reads_every_page_in_parallel(spark, tmp_path):
    pages = {1: [{"id": i, "school.name": f"s{i}", "school.ownership": 1} for i in range(100)],
             2: [{"id": 100 + i, "school.name": f"t{i}"} for i in range(100)],
             3: [{"id": 200 + i} for i in range(50)]}
    url = _land(tmp_path, pages, 250)
    explicit = read_api(spark, url, pages=3, pages_per_partition=2)
    discovered = read_api(spark, url)   # page count from metadata.total
    for df in (explicit, discovered):
        rows = df.select("school_id", "name", "ownership", "page", "pos").collect()
        assert len(rows) == 250
        got = {r.school_id: (r.page, r.pos) for r in rows}
        assert got[0] == (1, 0) and got[199] == (2, 99) and got[249] == (3, 49)
        assert {r.name for r in rows if r.school_id == 5} == {"s5"}


def test_projected_fields_only(spark, tmp_path):
    url = _land(tmp_path, {1: [{"id": 1, "school.name": "a", "school.city": "c"}]}, 1)
    df = read_api(spark, url, pages=1, fields="id,school.name")
    assert df.columns == ["school_id", "name", "page", "pos"]


def test_missing_page_fails_after_retries(tmp_path):
    with pytest.raises(Exception):
        fetch_json("file://" + str(tmp_path) + "/absent.json", retries=1, backoff=0)


def _pages(first, sizes, start=0):
    out, at = {}, start
    for i, n in enumerate(sizes):
        out[first + i] = [{"id": at + j} for j in range(n)]
        at += n
    return out


def _ids(df):
    return sorted(r.school_id for r in df.select("school_id").collect())


@pytest.mark.parametrize("first", [0, 1])
@pytest.mark.parametrize("pages", [None, 1, 2, 3, 9])
def test_any_base_and_a_stale_page_count_lose_nothing(spark, tmp_path, first, pages):
    url = _land(tmp_path, _pages(first, [100, 100, 50]), 250)
    options = {} if pages is None else {"pages": pages}
    if pages == 9:  # more pages claimed than there are: an absent page inside the range is an error
        with pytest.raises(Exception):
            _ids(read_api(spark, url, retries=0, **options))
        return
    assert _ids(read_api(spark, url, retries=0, **options)) == list(range(250))


@pytest.mark.parametrize("first", [0, 1])
def test_without_metadata_reads_until_an_empty_page(spark, tmp_path, first):
    for n, records in _pages(first, [100, 100, 7, 0]).items():
        (tmp_path / f"page-{n}.json").write_text(json.dumps({"results": records}))
    (tmp_path / "page-9.json").write_text(json.dumps({"results": [{"id": 999}]}))
    assert _ids(read_api(spark, "file://" + str(tmp_path) + "/page-{page}.json", retries=0)) == list(range(207))


def test_stale_total_still_reads_on(spark, tmp_path):
    url = _land(tmp_path, _pages(1, [100, 100, 50]), 120)
    assert _ids(read_api(spark, url, retries=0)) == list(range(250))


def test_landing_counts_against_the_total(spark, tmp_path):
    from campuslens.sources.api import land_api
    from campuslens.sources.pages import extract

    src = tmp_path / "src"
    src.mkdir()
    url = _land(src, _pages(0, [100, 30]), 130)
    assert land_api(spark, url, str(tmp_path / "landed"), retries=0) == 130
    assert _ids(extract(spark, str(tmp_path / "landed"))) == list(range(130))
    short = tmp_path / "short"
    short.mkdir()
    with pytest.raises(ValueError):
        land_api(spark, _land(short, _pages(0, [100, 20]), 130), str(tmp_path / "landed2"), retries=0)


def test_fields_page_size_and_key_are_in_the_request():
    from campuslens.sources.api import Requests

    reader = Requests({"url": ""}, [])
    reader.url, reader.per_page, reader.api_key, reader.fields = "https://x.example/s?page={page}", 20, "k", ["id", "school.name"]
    assert reader.page_url(3) == "https://x.example/s?page=3&fields=id%2Cschool.name&per_page=20&api_key=k"
    reader.url = "file:///tmp/{page}-{fields}-{per_page}.json"
    assert reader.page_url(0) == "file:///tmp/0-id,school.name-20.json"


def test_broken_connections_are_retried(monkeypatch):
    import http.client

    from campuslens.sources import api

    class Body:
        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def read(self):
            return b'{"results": []}'

    errors = [TimeoutError(), ConnectionResetError(), http.client.IncompleteRead(b"")]

    def open_(url, timeout):
        if errors:
            raise errors.pop()
        return Body()

    monkeypatch.setattr(api.urllib.request, "urlopen", open_)
    assert fetch_json("http://x.example", backoff=0) == {"results": []}
