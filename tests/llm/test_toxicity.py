import binascii

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from campuslens.llm import toxicity as T
from campuslens.llm.queries import QUERIES


def sample(rng, n, bad):
    vocab = ["".join(rng.choice(list("aeioulnrst"), int(rng.integers(2, 9)))) for _ in range(800)]
    texts, labels = [], []
    for _ in range(n):
        words = list(rng.choice(vocab, int(rng.integers(15, 150))))
        y = int(rng.random() < 0.25)
        for _ in range(y * max(1, len(words) // 30)):
            words[int(rng.integers(len(words)))] = str(rng.choice(bad))
        texts.append(" ".join(words))
        labels.append(y)
    return texts, labels


def scores(model, texts):
    out = []
    for _, flat, off in T.bags(pa.array(texts, pa.large_string())):
        total = np.concatenate([[0], np.cumsum(model.weight[flat].astype(float))])[off]
        out.append(np.diff(total) / np.maximum(np.diff(off), 1))
    return model.score(np.concatenate(out))


def auc(y, p):
    y, rank = np.array(y), np.argsort(np.argsort(p))
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(y) - n1))


def test_learns_and_carries_over_to_unseen_misspellings():
    rng = np.random.default_rng(0)
    model = T.fit(*sample(rng, 1500, ["worthless", "disgusting", "pathetic"]))
    known = sample(rng, 400, ["worthless", "disgusting", "pathetic"])
    odd = sample(rng, 400, ["worthlesss", "disgustingg", "patheticc", "xpathetic"])
    assert auc(known[1], scores(model, known[0])) > 0.97
    assert auc(odd[1], scores(model, odd[0])) > 0.9


def test_degenerate_training_sets():
    for texts, labels in (([], []), (["a"], [1]), (["a", None], [0, 0]), ([None, ""], [0, 1])):
        model = T.fit(texts, labels)
        p = scores(model, ["anything", "", None])
        assert np.isfinite(p).all() and ((0 <= p) & (p <= 1)).all()


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame([(1, "bad worthless thing", "x"), (2, "good thing", "y"), (2, "good thing", "y"), (3, None, ""),
                                  (None, "", "z"), (4, "w" * 50_000 + " " + "thing " * 20_000, "q")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    model = T.train(docs, labels)
    rows = T.score(docs, model).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 2}) == 1
    assert T.score(docs.limit(0), T.train(docs, labels.limit(0))).count() == 0


def test_held_out_fold(spark):
    ids = spark.range(500).select(F.col("id").alias("doc_id")).withColumn("h", T.held_out())
    assert all(r["h"] == (binascii.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in ids.collect())


def test_held_out_accuracy_on_given_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = (QUERIES["op6_toxicity"](spark, sf)
           .join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas())
    assert auc(got.toxic, got.score) > 0.92
    assert ((got.predicted == 1) & (got.toxic == 0)).sum() <= 0.03 * (got.toxic == 0).sum()


def test_runs_of_any_length_have_their_n_grams():
    rng = np.random.default_rng(31)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    bad, good = [word() for _ in range(12)], [word() for _ in range(200)]
    pick = lambda words, n: [words[int(i)] for i in rng.integers(0, len(words), n)]
    texts = [" ".join(pick(good, 30) + (pick(bad, 6) if k % 2 else [])) for k in range(400)]
    model = T.fit(texts, [k % 2 for k in range(400)])
    mean = lambda text: np.mean(model.weight[T.features(text.encode())])
    joined = [("".join(pick(bad, 20)), "".join(pick(good, 20))) for _ in range(20)]
    assert all(len(a) > 64 and model.score(mean(a)) > model.score(mean(b)) for a, b in joined)
