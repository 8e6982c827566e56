import duckdb
import numpy as np
import pandas as pd
import pytest

from campuslens.llm import jaccard_join as J
from campuslens.llm.components import components
from campuslens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(doc_id, n_shingles, component_id, n_links), pair by pair."""
    sets = {}
    for doc, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
        sets[doc] = ({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5
                     else {tuple(words)} if words else set())
    docs = sorted(sets)
    link = {d: [e for e in docs if e != d and sets[d] and sets[e]
                and 100 * len(sets[d] & sets[e]) >= 80 * len(sets[d] | sets[e])] for d in docs}
    out = {}
    for d in docs:
        seen, todo = {d}, [d]
        while todo:
            for e in link[todo.pop()]:
                if e not in seen:
                    seen.add(e)
                    todo.append(e)
        out[d] = (len(sets[d]), min(seen), len(link[d]))
    return out


def corpus():
    rng = np.random.default_rng(1)
    vocab = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    line = " ".join(f"common{i}" for i in range(12))
    for group in range(12):
        base = list(rng.choice(vocab, int(rng.integers(5, 90))))
        for copy in range(int(rng.integers(1, 30))):
            words = list(base)
            for _ in range(int(rng.integers(0, 3))):
                words[int(rng.integers(len(words)))] = str(rng.choice(vocab))
            if rng.random() < 0.2:
                words = words + line.split()
            rows.append((doc, " ".join(words)))
            doc += int(rng.integers(1, 3))
    base = [f"hot{i}" for i in range(140)]
    for copy in range(600):  # a large group of near copies over several groups of sets
        words = list(base)
        words[int(rng.integers(140))] = f"edit{copy}"
        rows.append((doc, " ".join(words)))
        doc += 1
    rows += [(doc + 1, "One two THREE"), (doc + 2, "one  two\tthree "), (doc + 3, ""), (doc + 4, None),
             (doc + 5, " \n "), (doc + 6, "x " * 6000), (doc + 7, "X " * 9000), (doc + 8, line), (doc + 9, line + " more")]
    return rows


def test_against_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, sig string")
    got = J.similarity_classes(docs.repartition(5)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    wrong = [(r, want[r["doc_id"]]) for r in got
             if (r["n_shingles"], r["component_id"], r["n_links"]) != want[r["doc_id"]]]
    assert not wrong, wrong[:5]


def test_nulls_repeats_and_empty_table(spark):
    text = "a b c d e f g h i j"
    docs = spark.createDataFrame([(None, text), (5, text), (5, text), (9, text + " k"), (None, None)],
                                 "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["n_links"])
                 for r in J.similarity_classes(docs).collect())
    assert got == [("5", 6, 5, 1), ("5", 6, 5, 1), ("9", 7, 5, 1), ("None", 0, None, 0), ("None", 6, None, 0)]
    assert J.similarity_classes(docs.limit(0)).count() == 0


def test_registered_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(ORACLES["op1_jaccard_join"]).df()
    got = QUERIES["op1_jaccard_join"](spark, SF).toPandas()[list(want.columns)]
    key = ["doc_id"]
    pd.testing.assert_frame_equal(got.sort_values(key).reset_index(drop=True),
                                  want.sort_values(key).reset_index(drop=True), check_dtype=False)


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)],
                                   [(9, 3), (3, 9), (4, 4), (7, 3), (20, 21), (22, 21)]])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in
           components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else top(parent[x])

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: top(n) for n in linked}


def test_rows_that_share_an_id_link_by_their_own_texts(spark):
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(40))
    rows = [(3, text(1)), (5, text(1) + " x"), (5, text(2)), (7, text(2) + " x"), (5, text(3)), (9, text(3) + " y"), (11, text(4))]
    got = J.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [
        (3, 3), (5, 3), (5, 5), (5, 5), (7, 5), (9, 5), (11, 11)]
