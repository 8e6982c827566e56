import duckdb
import pandas as pd
from pyspark.sql import functions as F

from campuslens.llm import mixing as M
from campuslens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, taken string"


def brute_targets(sizes):
    """{source: target} by clamping and resharing until no source is above its cap."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        total = sum(weight[s] for s in names if s not in capped)
        share = {s: rest * weight[s] / total for s in names if s not in capped}
        over = {s for s, t in share.items() if t > 3 * sizes[s]}
        if not over:
            return {s: float(3 * sizes[s]) if s in capped else share[s] for s in names}
        capped |= over


def corpus(spark):
    rows = [(i, "w " * (i % 37), "en", f"s{i % 5}", 0, "clash") for i in range(300)]
    rows += [(1000 + i, "one two  three\nfour", "x", None, 19, "c") for i in range(5)]
    rows += [(2000, "é " * 4000, "x", "big", 0, "c"), (2001, None, "x", "empty", 0, None), (2002, "", "x", "empty", 0, None),
             (None, "no id here", "x", "s1", 0, None), (7, "a b", "x", "s1", 0, ""), (7, "a b", "x", "s1", 0, ""),
             (3000, "few", "x", "Ztiny", 3, ""), (3001, "words", "x", "älong", 5, "")]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_targets_and_taken_words(spark):
    rows, docs = corpus(spark)
    sizes = {}
    for _, text, _, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = brute_targets(sizes)
    mixed = M.mix(docs.repartition(6))
    assert set(mixed.columns) == {"doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "taken"}
    got = mixed.toPandas()
    assert len(got) == len(rows)
    for source, target in want.items():
        own = got[got.source.isna()] if source is None else got[got.source == source]
        assert (own.source_size == sizes[source]).all() and abs(own.target - target).max() < 1e-6
        assert abs(own.taken.sum() - target) <= 0.5
    assert (got.taken <= 3 * got["size"]).all() and (got.taken >= 0).all()
    assert any(t == 3 * sizes[s] for s, t in want.items())  # a cap was reached


def test_reruns_and_other_partitions_agree(spark):
    _, docs = corpus(spark)
    one, two = (sorted(map(str, M.mix(d).drop("n_chars").collect())) for d in (docs.repartition(2), docs.repartition(7)))
    assert one == two
    assert M.mix(docs.limit(0)).count() == 0


def test_repeated_documents_hold_the_words_taken(spark):
    _, docs = corpus(spark)
    mixed = M.mix(docs)
    out = M.repeat(mixed)
    words = lambda df: {r[0]: r[1] for r in df.groupBy(F.coalesce("source", F.lit("-"))).agg(
        F.sum(F.regexp_count("text", F.lit(M.WORD)))).collect() if r[1]}
    taken = {r[0]: r[1] for r in mixed.groupBy(F.coalesce("source", F.lit("-"))).agg(F.sum("taken")).collect() if r[1]}
    assert words(out) == taken
    whole = {r["text"] for r in docs.collect()}
    cut = [r for r in out.collect() if r["text"] not in whole]
    assert all(any(t and t.startswith(r["text"]) for t in whole) and r["n_chars"] == len(r["text"]) for r in cut)


def test_no_words_at_all(spark):
    docs = spark.createDataFrame([(1, None, "x", "a", 0, ""), (2, " ", "x", None, 0, "")], SCHEMA)
    assert {(r["size"], r["target"], r["taken"]) for r in M.mix(docs).collect()} == {(0, 0.0, 0)}
    assert M.repeat(M.mix(docs)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = M.mix(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_registered_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(ORACLES["op5_mixing"]).df()
    got = QUERIES["op5_mixing"](spark, SF).toPandas()[list(want.columns)]
    pd.testing.assert_frame_equal(got.sort_values("doc_id").reset_index(drop=True),
                                  want.sort_values("doc_id").reset_index(drop=True), check_dtype=False)
