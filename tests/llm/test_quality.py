import binascii

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from campuslens.llm import quality as Q
from campuslens.llm import toxicity
from campuslens.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def bags(texts, counts=None):
    out = []
    for lo, hi, b, v, off in Q.features(pa.array(texts, pa.large_string()), counts):
        out += [(b[off[i]:off[i + 1]], v[off[i]:off[i + 1]]) for i in range(hi - lo)]
    return out


def test_linear_time_form_equals_all_pairs():
    rng = np.random.default_rng(1)
    model = Q.Model(0.3, rng.normal(0, 1, Q.BUCKETS), rng.normal(0, 1, (Q.BUCKETS, Q.FACTORS)))
    for bucket, value in bags(["one two three two", "", "A short text, with 3 lines.\nAnd\nmore **", None, "x " * 50]):
        want = 0.3 + float((model.weight[bucket] * value).sum())
        for i in range(len(bucket)):
            for j in range(i):
                want += float(model.factor[bucket[i]] @ model.factor[bucket[j]]) * value[i] * value[j]
        assert model.logits(bucket, value, np.array([0, len(bucket)]))[0] == pytest.approx(want, rel=1e-4)


def test_statistics_by_their_definition():
    text = "Aa bb bb 12 ** éé\nbb!"
    bucket, value = bags([text], np.array([22.0]))[0]
    stats = {k: int(b) for k in range(len(Q.STATISTICS)) for b in bucket - Q.WORDS - k * Q.BINS
             if 0 <= b < Q.BINS}
    words = text.split()
    share = lambda x: int(Q._fine(np.array([x]))[0])
    assert stats[0] == int(np.log2(len(words) + 1)) and stats[1] == int(sum(len(w.encode()) for w in words) / 7)
    assert stats[2] == int(6 / 7 * 15) and stats[3] == int(7 / 7 * 15) and stats[4] == share(1 / 7)
    assert stats[5] == share(1 / 8) and stats[6] == share(2 / 23) and stats[7] == 0 and stats[8] == share(3 / 23)
    assert stats[9] == share(4 / 23) and stats[10] == int(np.log2(7 / 2 + 1))
    assert stats[11] == share(2 / 7) and stats[12] == share(2 / 7)
    assert Q.META + 4 in bucket and len(bucket) == 6 + len(Q.STATISTICS) + 1
    assert (value[:6] ** 2).sum() == pytest.approx(1)


def test_pairs_matter():
    """Neither word alone tells the label: only their pair does."""
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for _ in range(1200):
        a, b = rng.integers(0, 2, 2)
        texts.append(" ".join(["left" if a else "right", "up" if b else "down"]))
        labels.append(int(a == b))
    all_bags = bags(texts)
    model = Q.fit(all_bags[:900], labels[:900])
    p = np.array([model.score(b, v, np.array([0, len(b)]))[0] for b, v in all_bags[900:]])
    assert ((p >= 0.5) == np.array(labels[900:])).mean() > 0.95


def test_held_out_documents(spark):
    got = QUERIES["op11_quality"](spark, SF).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    rows = got.join(labels, how="inner")
    held = rows[rows.held_out]
    assert all(h == (binascii.crc32(str(i).encode()) % 5 == 0) for i, h in got.held_out.items())
    rank = held.score.rank()
    good, n = held.quality == 1, len(held)
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (n - good.sum()))
    assert auc > 0.99
    assert (held.predicted[good] == 1).mean() > 0.99 and (held.predicted[~good] == 0).mean() > 0.9
    assert got.score.between(0, 1).all() and len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_labels_and_ids_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("doc_id < 400")
    turned = labels.withColumn("quality", F.when(toxicity.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (Q.train(docs, x, ~toxicity.held_out()) for x in (labels, turned))
    assert (one.weight == two.weight).all() and (one.factor == two.factor).all() and one.bias == two.bias


def test_odd_rows(spark):
    rows = [(1, "good words here", 15, 0.5, "x"), (1, "good words here", 15, 0.5, "x"), (2, None, None, None, None),
            (3, "", 0, 1.0, "y"), (None, "AAA!! AAA!! " * 20000, -5, 0.0, None), (4, "AAA!! AAA!!", None, 0.0, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, score double, `n.x` string").repartition(3)
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (4, 0), (2, None), (None, 1), (9, 1)], "doc_id long, quality int")
    model = Q.train(docs, labels)
    got = Q.score(docs, model)
    assert got.columns == ["doc_id", "text", "n_chars", "n.x", "score", "predicted"]
    out = got.collect()
    assert len(out) == len(rows) and len({r["score"] for r in out if r["doc_id"] == 1}) == 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert Q.score(docs.drop("n_chars"), model).count() == len(rows)
    assert Q.score(docs.limit(0), model).count() == 0
    one_class = Q.train(docs, labels.where("quality = 1"))
    assert len({round(r["score"], 9) for r in Q.score(docs, one_class).collect()}) == 1
    assert Q.train(docs.limit(0), labels).score(np.zeros(1, int), np.ones(1), np.array([0, 1]))[0] == pytest.approx(0.5)
