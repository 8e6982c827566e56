"""Incremental ingest: idempotent reruns and replayed batches."""

import pytest

from campuslens.plans import load as L
from campuslens.schemas import FACT_COLUMNS
from campuslens.session import scratch_path
from campuslens.sources import pages as PG
from campuslens.sources.standin import school_raw
from campuslens.streaming import incremental as I
from campuslens.streaming.incremental import process_batch, run_available

from conftest import SF_SMALL


def _keys(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_runs_equal_batch_load_and_rerun_is_noop(spark):
    root = scratch_path(spark, "stream-test")
    landing, state, ckpt = f"{root}/landing", f"{root}/state", f"{root}/ckpt"
    for run in ("earlier", "later"):
        PG.land_pages(school_raw(spark, SF_SMALL, **L.run_window(run)), f"{landing}/run={run}")
        tables = run_available(spark, landing, state, ckpt, ["run"])
    assert tables.committed() == [0, 1]
    expected = L.load_university(spark, SF_SMALL)
    assert _keys(tables.current("university").select(*FACT_COLUMNS)) == _keys(expected)

    # the committed tables are queryable with SQL
    tables.register_views("t_")
    joined = spark.sql("SELECT count(*) AS n FROM t_university u JOIN t_dim_program d"
                       " ON u.program_id = d.program_id").first().n
    assert joined == expected.where("program_id IS NOT NULL").count()

    # nothing new landed: the stream commits nothing and the state is unchanged
    tables = run_available(spark, landing, state, ckpt, ["run"])
    assert tables.committed() == [0, 1]

    # a replayed batch id is skipped
    later_pages = spark.read.schema(
        "page long, results array<struct<id:bigint>>").json(f"{landing}/run=later")
    process_batch(tables, later_pages, 1, tables.loads()[-1].stream)
    assert tables.committed() == [0, 1]
    assert _keys(tables.current("university").select(*FACT_COLUMNS)) == _keys(expected)


def test_repeated_school_in_a_batch_fails_or_keeps_latest(spark, tmp_path):
    import json

    import pytest

    def land(root):
        d = root / "landing" / "run=a"
        d.mkdir(parents=True)
        lines = [{"page": 1, "results": [{"id": 1, "school.name": "old"}, {"id": 2, "school.name": "b"}]},
                 {"page": 2, "results": [{"id": 1, "school.name": "new"}]}]
        (d / "part-0.json").write_text("\n".join(json.dumps(x) for x in lines) + "\n")
        return str(root / "landing")

    strict_root = tmp_path / "strict"
    with pytest.raises(Exception):
        run_available(spark, land(strict_root), str(strict_root / "state"), str(strict_root / "ckpt"), ["run"])

    lenient_root = tmp_path / "lenient"
    tables = run_available(spark, land(lenient_root), str(lenient_root / "state"),
                           str(lenient_root / "ckpt"), ["run"], on_repeat="latest")
    names = {r.school_id: r.name for r in tables.current("university").collect()}
    assert names == {1: "new", 2: "b"}


def _land(root, runs):
    """runs: {run: {page: [(id, name)]}}; returns the landing root."""
    import json

    for run, pages in runs.items():
        d = root / "landing" / f"run={run}"
        d.mkdir(parents=True)
        lines = [{"page": p, "results": [{"id": i, "school.name": n} for i, n in rows]} for p, rows in pages.items()]
        (d / "part-0.json").write_text("\n".join(json.dumps(x) for x in lines) + "\n")
    return str(root / "landing")


def _names(tables):
    return sorted((r.school_id, r.name) for r in tables.current("university").collect() if r.school_id is not None)


def test_new_checkpoint_on_old_state_loads_new_data(spark, tmp_path):
    landing, state = _land(tmp_path, {"a": {1: [(1, "one")]}}), str(tmp_path / "state")
    run_available(spark, landing, state, str(tmp_path / "ckpt1"), ["run"])
    _land(tmp_path, {"b": {1: [(2, "two")]}})
    tables = run_available(spark, landing, state, str(tmp_path / "ckpt2"), ["run"])  # batch ids start at 0 again
    assert _names(tables) == [(1, "one"), (2, "two")] and tables.committed() == [0, 1]


@pytest.mark.parametrize("mode", ["raise", "latest"])
def test_two_runs_in_one_batch_keep_the_latest_run(spark, tmp_path, mode):
    landing = _land(tmp_path, {"1": {1: [(5, "b")], 2: [(1, "old"), (2, "x")]}, "2": {1: [(1, "new"), (3, "y")]}})
    tables = run_available(spark, landing, str(tmp_path / "s"), str(tmp_path / "c"), ["run"], on_repeat=mode)
    assert _names(tables) == [(1, "new"), (2, "x"), (3, "y"), (5, "b")]


def test_null_ids_are_all_kept(spark, tmp_path):
    landing = _land(tmp_path, {"1": {1: [(None, "p"), (None, "q"), (4, "r")]}})
    for mode in ("raise", "latest"):
        tables = run_available(spark, landing, str(tmp_path / mode), str(tmp_path / f"c{mode}"), ["run"], on_repeat=mode)
        assert sorted(r.name for r in tables.current("university").collect()) == ["p", "q", "r"]


def test_batch_load_refuses_a_repeated_school(spark):
    top = L.stage(L.top(spark, SF_SMALL, k=5), "top")
    dp, dt = L.frame_dims(top)
    stored = L.fact(top).limit(0)
    with pytest.raises(ValueError):
        L.load(stored, dp, dt, top.union(top.limit(1)))


def _files(root):
    return {str(p) for p in (root / "s").rglob("*.parquet")}


def test_a_load_writes_only_what_it_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "FOLD_SHARE", 100.0)
    state, ckpt = str(tmp_path / "s"), str(tmp_path / "c")
    landing = _land(tmp_path, {"1": {1: [(i, f"n{i}") for i in range(40)] + [(None, "x")]}})
    run_available(spark, landing, state, ckpt, ["run"])
    before = _files(tmp_path)
    _land(tmp_path, {"2": {1: [(7, "changed"), (40, "new")]}})
    tables = run_available(spark, landing, state, ckpt, ["run"])
    new = [p for p in _files(tmp_path) - before if "/university/" in p]
    assert before < _files(tmp_path) and spark.read.parquet(*new).count() == 2
    want = [(i, "changed" if i == 7 else f"n{i}") for i in range(40)] + [(40, "new")]
    assert _names(tables) == want and tables.current("university").count() == 42
    # folded, the state is the same and the next load builds on it
    assert tables.fold(force=True) and _names(tables) == want and not tables.fold()
    assert [x.kind for x in tables.loads()] == ["delta", "delta", "base"] and tables.committed() == [0, 1]
    _land(tmp_path, {"3": {1: [(8, "again"), (7, "back")]}})
    tables = run_available(spark, landing, state, ckpt, ["run"])
    want = [(i, {7: "back", 8: "again"}.get(i, n)) for i, n in want]
    assert _names(tables) == want and tables.committed() == [0, 1, 2]
    # expiry deletes only what the kept loads do not use
    assert tables.expire(1) > 0 and _names(tables) == want and tables.current("dim_program").count() >= 1
    assert [x.kind for x in tables.loads()] == ["base", "delta"]
    assert tables.expire(1) == 0
    # a fold alone still has its load's dimensions
    assert tables.fold(force=True) and tables.expire(1) > 0 and _names(tables) == want
    assert [x.kind for x in tables.loads()] == ["base"] and tables.current("dim_program").count() >= 1


def test_growing_deltas_are_folded(spark, tmp_path):
    state, ckpt = str(tmp_path / "s"), str(tmp_path / "c")
    for n in range(4):
        landing = _land(tmp_path, {str(n): {1: [(i, f"{n}-{i}") for i in range(n, 30)]}})
        tables = run_available(spark, landing, state, ckpt, ["run"])
        assert _names(tables) == [(i, f"{min(i, n)}-{i}") for i in range(30)]
    assert "base" in {x.kind for x in tables.loads()}


def test_a_load_that_broke_off_is_not_there(spark, tmp_path):
    state, ckpt = str(tmp_path / "s"), str(tmp_path / "c")
    landing = _land(tmp_path, {"1": {1: [(1, "one")]}})
    tables = run_available(spark, landing, state, ckpt, ["run"])
    last = tables.loads()[-1]
    broken = tmp_path / "s" / "university" / "version=1" / "kind=delta" / "stream=x" / "batch=0"
    tables.current("university").write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    (broken / "._SUCCESS.crc").unlink(missing_ok=True)
    assert tables.loads() == [last] and _names(tables) == [(1, "one")]


def test_a_dimension_with_repeats_ends_the_load(spark, tmp_path):
    from campuslens.sources.tables import RepeatedKey

    tables = I.StoredTables(spark, str(tmp_path / "s"))
    load = I.Load(0, "delta", "q", "0")
    good = spark.createDataFrame([(1, "a"), (2, "b")], tables.schemas["dim_program"])
    assert tables.write(load, "dim_program", good).count() == 2
    for bad in ([(1, "a"), (2, "a")], [(1, "a"), (1, "b")]):
        with pytest.raises(RepeatedKey):
            tables.write(load, "dim_program", spark.createDataFrame(bad, tables.schemas["dim_program"]))
        assert not (tmp_path / "s" / "dim_program" / load.folder).exists()


def test_run_labels_are_utc_and_unique():
    import time

    from campuslens.__main__ import run_label

    one, two = run_label(), run_label()
    assert one != two and abs(int(one[:8]) - int(time.strftime("%Y%m%d", time.gmtime()))) <= 1
