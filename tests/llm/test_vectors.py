import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from campuslens.llm import ann, top_k
from campuslens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, score string, rank int, vec string"
NAN, INF = float("nan"), float("inf")
ODD = [(None, [1.0, 2.0]), (1000, None), (1001, [1.0, None]), (1002, [NAN, 1.0]), (1003, [INF, 0.0]),
       (1004, []), (1005, [0.5]), (1006, [0.5])]


def brute_top_k(rows, k, every):
    out = {}
    good = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for i, q in good:
        if i % every == 0:
            scored = sorted((-int(q @ x), j) for j, x in good if j != i and len(x) == len(q))
            out[i] = [(r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties", "few"])
def test_top_k_against_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    n, d = {"dense": (700, 24), "sparse": (900, 60), "ties": (500, 4), "few": (5, 3)}[kind]
    x = rng.standard_normal((n, d))
    if kind == "sparse":
        x = np.where(rng.random((n, d)) < 0.06, np.abs(x), 0)
    if kind == "ties":
        x = rng.integers(-1, 2, (n, d)) / 2.0
        x[50:350] = x[50]
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    rows += ODD + [(7, rows[3][1])] * (kind == "ties")
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(4)
    got = {}
    for r in top_k.top_k(docs, F.col("vec_id") % 10 == 0, 10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = {i: v for i, v in brute_top_k(rows, 10, 10).items() if v}
    assert {i: sorted(v) for i, v in got.items()} == want


def test_top_k_equals_its_sql_and_takes_an_empty_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(ORACLES["op4_top_k"]).df()
    got = QUERIES["op4_top_k"](spark, SF).toPandas()[list(want.columns)]
    key = ["query_id", "rank"]
    pd.testing.assert_frame_equal(got.sort_values(key).reset_index(drop=True),
                                  want.sort_values(key).reset_index(drop=True), check_dtype=False)
    empty = spark.read.parquet(f"{SF}/embeddings.parquet").limit(0)
    assert top_k.top_k(empty, F.col("vec_id") % 10 == 0, 10).count() == 0
    assert ann.nearest(empty, F.col("vec_id") % 10 == 0, 10).count() == 0


def test_pruning_leaves_results_alone():
    rng = np.random.default_rng(8)
    ids, x = np.arange(500) * 3, rng.integers(-500, 500, (500, 30))
    shard = top_k.Shard(ids, x)
    for q in rng.integers(-500, 500, (40, 30)):
        best, score = shard.search(9, q, 7)
        all_ = sorted((-int(s), int(i)) for i, s in zip(ids, x @ q) if i != 9)[:7]
        assert [(-s, i) for i, s in zip(best.tolist(), score.tolist())] == [(s, i) for s, i in all_] or (
            list(zip((-score).tolist(), best.tolist())) == all_)


def recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], float)
    got = QUERIES["op9_nearest"](spark, sf_dir).toPandas()
    queries = np.flatnonzero(ids % 20 == 0)
    hits = 0
    by = dict(tuple(got.groupby("query_id")))
    assert set(by) == set(ids[queries].tolist())
    for q in queries:
        score = x @ x[q]
        score[q] = -np.inf
        want = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        own = by[ids[q]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and own.score.is_monotonic_decreasing
        assert np.allclose(own.score, [x[q] @ x[int(np.flatnonzero(ids == j)[0])] for j in own.vec_id], atol=1e-12)
        hits += len(want & set(own.vec_id.tolist()))
    return hits / (20 * len(queries))


def test_nearest_recall_on_given_vectors(spark):
    assert recall(spark, "/root/testdata/sf0.1") >= 0.9


def test_nearest_recall_with_a_deep_forest_and_unequal_norms(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 16))
    x = (centres[rng.integers(0, 20, 3000)] + 0.3 * rng.standard_normal((3000, 16))) * rng.uniform(0.5, 2, (3000, 1))
    docs = spark.createDataFrame([(int(i), [float(c) for c in v], "x", 1, "y") for i, v in enumerate(x)]
                                 + [(None, [1.0] * 16, "", 0, ""), (4000, [0.0] * 16, "", 0, ""),
                                    (4020, [NAN] * 16, "", 0, ""), (4040, [1.0], "", 0, ""), (4041, [2.0], "", 0, ""), (3, [float(c) for c in x[3]], "", 0, "")],
                                 SCHEMA)
    got = ann.nearest(docs, F.col("vec_id") % 20 == 0, 20, leaf=32, sample=1000).toPandas()
    stored = x.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, 3000, 20):
        score = stored @ stored[q]
        score[q] = -np.inf
        own = got[got.query_id == q]
        assert len(own) == 20 and own.vec_id.is_unique
        hits += len(set(np.argsort(-score)[:20].tolist()) & set(own.vec_id.tolist()))
    assert hits >= 0.9 * 20 * 150 and set(got.query_id) == {*range(0, 3000, 20), 4040}
    assert got[got.query_id == 4040].vec_id.tolist() == [4041]


def test_few_vectors_give_all_candidates(spark):
    docs = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 0.5])], "vec_id long, embedding array<float>")
    got = ann.nearest(docs, F.col("vec_id") == 0, 20).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 1.0), (2, 2, -1.0)]


def test_every_length_is_searched(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 50)
    monkeypatch.setattr(ann, "FORESTS", 2)
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(c) for c in rng.standard_normal(d)])
            for i, d in enumerate([4] * 400 + [2] * 300 + [3] * 40 + [1] * 3)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = ann.nearest(docs, F.col("vec_id") % 20 == 0, 5, leaf=16).toPandas()
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    hits = n = 0
    for q in range(0, len(rows), 20):
        own = got[got.query_id == q].sort_values("rank")
        near = sorted((-float(vectors[q] @ x), i) for i, x in vectors.items() if i != q and len(x) == len(vectors[q]))[:5]
        assert len(own) == len(near) and {len(vectors[i]) for i in own.vec_id} <= {len(vectors[q])}
        hits, n = hits + len({i for _, i in near} & set(own.vec_id)), n + len(near)
        if len(vectors[q]) not in (4, 2):  # without a forest: exhaustive
            assert own.vec_id.tolist() == [i for _, i in near]
    assert hits >= 0.9 * n


def test_repeated_ids_take_one_place(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0])] + [(5, [0.9, 0.01 * i]) for i in range(60)] + [(i, [0.5, 0.1]) for i in range(6, 30)]
    docs = spark.createDataFrame(rows + rows, "vec_id long, embedding array<double>")
    got = ann.nearest(docs, F.col("vec_id") == 0, 3).collect()  # the smaller vector asks: (0, 1)
    assert [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 5), (2, 6), (3, 7)]


def test_leaves_open_in_the_order_of_a_queue():
    import heapq

    rng = np.random.default_rng(4)
    x, q = rng.standard_normal((800, 10)), rng.standard_normal((20, 10))
    forest = ann.Forest(x, 3, 20, 1)
    rows = np.bincount(forest.leaves_of(x).ravel(), minlength=forest.leaves)
    shares = forest.shares(q, rows)
    for i in range(20):
        queue, order = [(0.0, t, tree.root) for t, tree in enumerate(forest.trees)], []
        while queue:
            cost, t, node = heapq.heappop(queue)
            if node < 0:
                order.append(int(forest.first[t]) - node - 1)
                continue
            tree = forest.trees[t]
            margin = float(tree.normals[node] @ q[i] - tree.offsets[node])
            for child, beyond in zip(tree.children[node].tolist(), (max(margin, 0.0), max(-margin, 0.0))):
                heapq.heappush(queue, (cost + beyond ** 2, t, child))
        assert (np.diff(shares[i][order]) > 0).mean() > 0.99  # ties of equal cost aside
        assert np.allclose(sorted(shares[i]), np.cumsum(rows[np.argsort(shares[i])]) / 800)


def test_clustered_vectors_need_few_rows():
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((50, 32))
    clustered = centres[rng.integers(0, 50, 4000)] + 0.15 * rng.standard_normal((4000, 32))
    even = rng.standard_normal((4000, 32))
    need = []
    for x in (clustered, even):
        largest = float(np.linalg.norm(x, axis=1).max())
        lifted = ann.lift(x, largest)
        forest = ann.Forest(lifted, 4, 32, 1)
        some = np.arange(0, 4000, 40)
        need.append(forest.measured(lifted, some, ann.aim(x[some], largest), 20, 0.95))
    assert need[0] < 0.3 < 0.6 < need[1]
