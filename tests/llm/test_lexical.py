import math
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from campuslens.llm import lexical as X
from campuslens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, k):
    """Every pair scored by its definition."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    df = Counter(t for _, b in bags for t in b)
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    out = []
    for item, text in items:
        scored = []
        for i, bag in bags:
            m = 100 - 50 + (50 * sum(bag.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in set(terms(text)) if t in bag)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return out


def texts(rng, n, words):
    """Documents of three word ranges, so that hierarchies can tell them apart."""
    out = []
    for i in range(n):
        base = 400 * (i % 3)
        size = int(rng.integers(0, words))
        out.append(" ".join(f"w{base + int(400 * rng.random() ** 3)}" for _ in range(size)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # many trees a task, blocks of few items
        monkeypatch.setattr(X, "TREE_TERMS", 500)
        monkeypatch.setattr(X, "BLOCK_BYTES", 600)
        monkeypatch.setattr(X, "DOC_LEAF", 4)
        monkeypatch.setattr(X, "SEED", 3)
    rng = np.random.default_rng(4)
    docs = list(enumerate(texts(rng, 300, 60)))
    docs += [(1000 + i, docs[5][1]) for i in range(150)]  # copies: ties at the end of a list
    docs += [(None, docs[5][1]), (None, "w1 w2"), (2000, None), (2001, ""), (2002, "., \t!"), (3, docs[3][1]),
             (3, docs[3][1]), (2003, "Ünïcode wörd joined naïve W1"), (2004, "w1 " * 30000)]
    items = [(i, t) for i, t in enumerate(texts(rng, 30, 25))]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, docs[5][1]), (104, "W1 w1 W2"), (105, "wörd joined")]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, terms string").repartition(5)
    q = spark.createDataFrame([(*r, 2) for r in items + items[:2]], "item_id long, text string, rank int")
    got = [tuple(r) for r in X.ranked(d, q, 20).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=str) == sorted(brute(docs, items, 20), key=str)
    assert len(got) > 300


def test_bounds_prune_and_lose_nothing():
    rng = np.random.default_rng(6)
    n, width = 2000, 900

    def vectors(n, size, most):
        rows = [np.unique(300 * (i % 3) + (300 * rng.random(size) ** 2).astype(np.int64)) for i in range(n)]
        off = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        return off, np.concatenate(rows), rng.integers(1, most, off[-1])

    off, term, value = vectors(n, 30, 10 ** 6)
    ioff, iterm, _ = vectors(40, 12, 2)
    weights = rng.integers(1, 9000, width)
    dense, items = np.zeros((n, width), np.int64), np.zeros((40, width), np.int64)
    dense[np.repeat(np.arange(n), np.diff(off)), term] = value
    items[np.repeat(np.arange(40), np.diff(ioff)), iterm] = weights[iterm]
    search = X.Search(X.Items(ioff, iterm, weights), 5, np.zeros(40, np.int64))
    ids = rng.permutation(n)
    search.add(off, term, value, ids, np.zeros(n, bool))
    assert search.scored < 0.6 * 40 * n  # most pairs are never scored
    got = sorted(zip(*(c.to_pylist() for c in search.results().columns)))
    scores = items @ dense.T
    want = sorted((j, int(ids[i]), int(scores[j, i])) for j in range(40)
                  for i in np.lexsort((ids, -scores[j]))[:5] if scores[j, i] > 0)
    assert got == want


def test_sums_beyond_doubles_are_exact():
    off, term = np.array([0, 3, 6]), np.array([0, 1, 2, 0, 1, 2])
    value = np.array([999_999, 999_998, 999_997, 999_999, 999_998, 999_996])
    weight = np.array([4_000_000_000, 3_999_999_999, 3_999_999_998])
    search = X.Search(X.Items(np.array([0, 3]), np.array([0, 1, 2]), weight), 1, np.zeros(1, np.int64))
    search.add(off, term, value, np.array([7, 8]), np.zeros(2, bool))
    assert search.results().to_pylist() == [{"item": 0, "doc_id": 7, "score": sum(int(w) * int(v) for w, v in zip(weight, value))}]


def test_equals_its_sql_and_takes_empty_tables(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLES["op13_lexical_search"]).df()
    got = QUERIES["op13_lexical_search"](spark, SF).toPandas()[list(want.columns)]
    key = ["item_id", "rank"]
    assert len(want) > 1000
    pd.testing.assert_frame_equal(got.sort_values(key).reset_index(drop=True),
                                  want.sort_values(key).reset_index(drop=True), check_dtype=False)
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    assert X.ranked(docs.limit(0), items).count() == 0
    assert X.ranked(docs, items.limit(0)).count() == 0
