import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from campuslens.llm import hard_negatives as H
from campuslens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, score string, tag string, block int"
NAN, INF = float("nan"), float("inf")


def brute(rows, every, scale=256, positives=5, negatives=10):
    """All scores, windows by their definition."""
    good = []
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and np.isfinite(x) for x in v):
            q = tuple(int(np.floor(scale * float(np.float32(x)))) for x in v)
            if (i, q, label) not in good:
                good.append((i, q, label))
    out = []
    for i, q, label in good:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, x)), j, same) for j, x, m in good
                        if j != i and len(x) == len(q) for same in [m == label])
        for score, j, _ in [s for s in scored if s[2]][:positives]:
            fits = [(-s, k) for s, k, same in scored if not same and 30 * -score <= -100 * s <= 90 * -score]
            out += [(i, j, r + 1, k, -score, s) for r, (s, k) in enumerate(fits[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties", "few labels", "many labels", "wide numbers", "few"])
def test_against_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(H, "SHARD_ROWS", 100)
    monkeypatch.setattr(H, "BLOCK_VALUES", 512)
    rng = np.random.default_rng(len(kind))
    n, d = {"few": (5, 3), "ties": (400, 4), "sparse": (500, 40)}.get(kind, (500, 24))
    x = rng.standard_normal((n, d))
    if kind == "sparse":
        x = np.where(rng.random((n, d)) < 0.1, np.abs(x), 0)
    if kind == "ties":
        x = rng.integers(-1, 2, (n, d)) / 2.0
        x[50:250] = x[50]
    if kind == "wide numbers":
        x = x * 4e5
    labels = rng.integers(0, {"few labels": 2, "many labels": 150}.get(kind, 5), n)
    rows = [(int(i), [float(c) for c in v], int(m)) for i, (v, m) in enumerate(zip(x.astype(np.float32), labels))]
    rows += [(None, [1.0], 1), (10, None, 1), (1001, [1.0, None], 1), (1002, [NAN, 1.0], 2), (1003, [INF, 0.0], 2),
             (1010, [], 1), (1020, [0.5], None), (1030, [0.5], 1), (1031, [0.5], 1), (1032, [0.25], 2),
             (1040, [0.0] * d, 1)]
    rows += [rows[0], rows[1], rows[1]] + [(0, rows[3][1], rows[3][2])] * (kind == "ties")
    df = spark.createDataFrame([(*r, "s", "t", 1) for r in rows], SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 10 == 0).collect())
    if kind == "ties":  # two anchors share a key there: each has its own ranks
        assert sorted(set(got)) == sorted(set(brute(rows, 10)))
    else:
        assert got == brute(rows, 10)
    assert got or kind == "few"


def test_threshold_join_finds_every_pair():
    rng = np.random.default_rng(9)
    for spread in (1.0, 0.02):  # near one direction, and in all of them
        x = np.floor(256 * (rng.standard_normal((700, 40)) * spread + (spread < 1) * rng.standard_normal(40))).astype(np.int64)
        index = H.Index(np.arange(700), np.zeros(700, np.int64), x)
        q, scores = x[:50], x[:50] @ x.T
        for share in (0.0, 0.5, 0.99, 0.9999):
            least = np.quantile(scores, share, axis=1).round()
            a, b, s = index.reaching(q[:, index.dims].astype(float), q[:, index.dims], least)
            want = {(i, j, int(scores[i, j])) for i, j in zip(*np.nonzero(scores >= least[:, None]))}
            assert set(zip(a.tolist(), b.tolist(), s.tolist())) == want


def test_equals_its_sql_and_takes_an_empty_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(ORACLES["op12_hard_negatives"]).df()
    got = QUERIES["op12_hard_negatives"](spark, SF).toPandas()[list(want.columns)]
    key = ["anchor_id", "positive_id", "rank"]
    assert len(want) > 100
    pd.testing.assert_frame_equal(got.sort_values(key).reset_index(drop=True),
                                  want.sort_values(key).reset_index(drop=True), check_dtype=False)
    empty = spark.read.parquet(f"{SF}/embeddings.parquet").limit(0)
    assert H.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
