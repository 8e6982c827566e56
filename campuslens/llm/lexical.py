"""Ranked lexical search of items over documents by two trees at once.

Documents' term contributions and items' term weights are sparse vectors
over the items' terms; a score is their product. Both sides have a hierarchy
of which every node holds the coordinate maxima below it, so the product of
an item node and a document node bounds every pair below both. The two are
descended together: a pair of nodes whose bound is below the weakest k-th
score of the node's items is dropped with all it holds; surviving leaves are
scored exactly. The more promising half of the documents comes first, which
raises the k-th scores early. Dropping is exact: nothing that is dropped
could be returned.

On Spark: one pass turns every whole text into its counts of the items'
terms (written once, never shuffled); a second sums the statistics of all
documents (a partial sum a task); then every task builds trees over its own
documents and keeps k results an item, and these are merged by rank. Before
that, a search of every ``SEED``-th document (by hash) gives each item a
k-th score that the true one cannot be below; all tasks start from it.
Items are dealt into blocks whose terms are small enough to travel with the
tasks (``BLOCK_BYTES`` of text, or one longer item).

Defined cases: a null text has no terms; a text without terms is in no
count and no result; documents of a null doc_id count like others and come
last among equal scores; repeated rows are documents of their own; items
equal in id and text are one item, items that share the id only are ranked
apart; an item without terms, or without documents of a score above 0, gives
nothing; empty tables give none; other columns are ignored. Terms are known
by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campuslens.llm.text import LOWER, binary_rows, chunks, distinct, hash_spans, spans
from campuslens.llm.workspace import Workspace

#: Bytes of a block's items, and the share of documents that seeds thresholds.
BLOCK_BYTES = 4 << 20
SEED = 64
#: Terms of the documents of one tree, documents of a leaf, power iterations of a split.
TREE_TERMS = 1 << 20
DOC_LEAF = 16
ROUNDS = 3
EXACT = 1 << 53

TERM = np.zeros(256, bool)
TERM[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1),
      *range(0x80, 0x100)]] = True


def term_hashes(column):
    """Yield (first row, last row + 1, hashes of the terms, each row's first term) of runs of rows."""
    for lo, hi, data, off in chunks(column):
        low = LOWER[data]
        starts, ends, rows = spans(TERM[low], off)
        yield lo, hi, hash_spans(low, starts, ends), rows


def _counted(terms: np.ndarray, rows: np.ndarray, width: int):
    """Distinct terms of every row in order: (terms, counts, offsets of the rows)."""
    key, count = np.unique(rows * width + terms, return_counts=True)
    return key % width, count, key // width


# ------------------------------------------------------------------ the trees
class Tree:
    """A binary hierarchy over sparse vectors; every node holds coordinate maxima.

    ``order`` lists the vectors so that a node's are ``order[first:last]``.
    A node is split along the direction in which its vectors, weighted by
    ``weight`` a term, vary most (a few power iterations), at the widest gap
    between a quarter and three quarters of them.
    """

    def __init__(self, off: np.ndarray, term: np.ndarray, value: np.ndarray, weight: np.ndarray, leaf: int):
        self.leaf, self.off, self.term, self.value = leaf, off, term, value
        n = len(off) - 1
        self.scaled = weight[term].astype(np.float64)
        square = np.concatenate([[0.0], np.cumsum(self.scaled ** 2)])
        self.scaled /= np.repeat(np.sqrt(np.maximum(square[off[1:]] - square[off[:-1]], 1.0)), np.diff(off))
        self.width, self.random = len(weight), np.random.default_rng(7)
        self.order = np.arange(n)
        self.first, self.last, self.left, self.maxima = [], [], [], []
        self._build(0, n)
        del self.scaled, self.term, self.value

    def _direction(self, own: np.ndarray) -> np.ndarray:
        """Where every vector lies along the direction of the widest variation."""
        at = _ranges(self.off[own], self.off[own + 1])
        term, scaled = self.term[at], self.scaled[at]
        whose = np.repeat(np.arange(len(own)), self.off[own + 1] - self.off[own])
        u = self.random.standard_normal(len(own))
        for _ in range(ROUNDS):
            u -= u.mean()
            v = np.bincount(term, scaled * u[whose], self.width)
            u = np.bincount(whose, scaled * v[term], len(own))
            u = u / max(float(np.abs(u).max()), 1e-300)
        return u

    def _build(self, first: int, last: int) -> int:
        node = len(self.first)
        for part, v in ((self.first, first), (self.last, last), (self.left, (-1, -1)), (self.maxima, None)):
            part.append(v)
        own = self.order[first:last]
        if last - first > self.leaf:
            u = self._direction(own)
            by = np.argsort(u, kind="stable")
            self.order[first:last] = own[by]
            lo = len(own) // 4
            gaps = np.diff(u[by])[lo:len(own) - lo - 1]
            middle = first + (lo + 1 + int(gaps.argmax()) if gaps.max() > 0 else len(own) // 2)
            self.left[node] = (self._build(first, middle), self._build(middle, last))
            parts = [self.maxima[c] for c in self.left[node]]
            terms, values = (np.concatenate(x) for x in zip(*parts))
        else:
            at = _ranges(self.off[own], self.off[own + 1])
            terms, values = self.term[at], self.value[at]
        by = np.argsort(terms, kind="stable")
        terms, values = terms[by], values[by]
        fresh = np.flatnonzero(np.diff(terms, prepend=-1))
        self.maxima[node] = (terms[fresh], np.maximum.reduceat(values, fresh) if len(fresh) else values)
        return node


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places starts[i]..ends[i] - 1 of all i, one after another."""
    n = ends - starts
    done = np.cumsum(n)
    return np.repeat(starts - (done - n), n) + np.arange(int(done[-1]) if len(done) else 0)


class Items:
    """A block's items as weighted term vectors with their hierarchy, of one item a leaf.

    Nodes are numbered from the root on, parents before their children.
    """

    def __init__(self, off: np.ndarray, term: np.ndarray, weights: np.ndarray):
        self.weights, self.width, weight = weights, len(weights), weights[term]
        tree = Tree(off, term, weight, weights, 1)
        self.order = tree.order
        at = _ranges(off[self.order], off[self.order + 1])  # in the tree's order from here on
        self.off = np.concatenate([[0], np.cumsum(np.diff(off)[self.order])])
        self.term, self.weight = term[at], weight[at]
        self.children = np.array(tree.left, np.int64).reshape(-1, 2)
        self.parent = np.full(len(self.children), -1)
        inner = np.flatnonzero(self.children[:, 0] >= 0)
        self.parent[self.children[inner]] = inner[:, None]
        self.item = np.where(self.children[:, 0] < 0, tree.first, -1)
        self.leaf = np.empty(len(self.order), np.int64)
        self.leaf[self.item[self.item >= 0]] = np.flatnonzero(self.item >= 0)
        # the nodes' maxima, one after another
        self.node_off = np.concatenate([[0], np.cumsum([len(t) for t, _ in tree.maxima])])
        self.node_term, self.node_most = (np.concatenate(x) for x in zip(*tree.maxima))
        sums = np.add.reduceat(weight, off[:-1]) if len(off) > 1 else np.zeros(1, np.int64)
        #: doubles hold every sum of contributions (below a million each) exactly
        self.exact = int(sums.max()) * 1_000_000 < EXACT


class Search:
    """The k best documents of every item, over as many trees as a task makes."""

    def __init__(self, items: Items, k: int, seed: np.ndarray):
        self.items, self.k = items, k
        n = len(items.order)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in range(n)]
        # of every node: the weakest k-th score below it, and the largest doc_id that such a score has
        # (no score below 1 is returned; until there are k, any doc_id is taken)
        self.weakest = np.zeros(len(items.parent), np.int64)
        self.late = np.full(len(items.parent), np.iinfo(np.int64).max)
        self.weakest[items.leaf] = np.maximum(seed[items.order], 1)
        for node in range(len(items.parent) - 1, 0, -1):
            self._raise(items.parent[node])
        self.scratch = np.zeros(items.width)
        self.column = np.full(items.width, -1)
        self.pairs = self.scored = 0

    def _raise(self, node: int) -> bool:
        """Take a node's values from its children; whether they changed."""
        pair = self.items.children[node]
        new = self.weakest[pair].min(), self.late[pair].max()
        changed = (self.weakest[node], self.late[node]) != new
        self.weakest[node], self.late[node] = new
        return changed

    def add(self, off, term, value, ids, missing):
        """Search one tree of documents: contributions ``value`` of terms, ids, and which ids are null."""
        if not len(term) or not len(self.best):
            return
        tree = Tree(off, term, value, self.items.weights, DOC_LEAF)
        self.docs = (off, term, value, np.where(missing, np.iinfo(np.int64).max, ids), missing)
        self._visit(tree, 0, *self._surviving(tree, 0, np.zeros(1, np.int64)))

    def _surviving(self, tree, node, nodes):
        """The item nodes that the document node may still serve, and by how much they exceed their scores."""
        if not len(nodes):
            return nodes, np.zeros(0)
        items = self.items
        terms, most = tree.maxima[node]
        self.scratch[terms] = most
        at = _ranges(items.node_off[nodes], items.node_off[nodes + 1])
        size = items.node_off[nodes + 1] - items.node_off[nodes]
        total = np.concatenate([[0.0], np.cumsum(items.node_most[at] * self.scratch[items.node_term[at]])])
        self.scratch[terms] = 0
        self.pairs += len(nodes)
        ends = np.cumsum(size)
        # running sums of integers: exact below 2^53, else enlarged by what rounding may lose
        bound = total[ends] - total[ends - size] + (0 if total[-1] < EXACT else total[-1] * 1e-12)
        over = bound - self.weakest[nodes]
        least_id = self.docs[3][tree.order[tree.first[node]:tree.last[node]]].min()
        keep = (over > 0) | ((over == 0) & (least_id <= self.late[nodes]))
        return nodes[keep], over[keep]

    def _visit(self, tree, node, nodes, over):
        """``nodes``: the item nodes that may find documents below ``node``."""
        items = self.items
        if tree.left[node] == (-1, -1):
            leaves = []
            while len(nodes):  # down to single items
                single = items.item[nodes] >= 0
                leaves.append(nodes[single])
                nodes, _ = self._surviving(tree, node, items.children[nodes[~single]].ravel())
            leaves = np.concatenate(leaves) if leaves else nodes
            if len(leaves):
                self._score(tree, node, items.item[leaves])
            return
        below = np.where(items.children[nodes] >= 0, items.children[nodes], nodes[:, None])
        below = np.concatenate([below[:, 0], below[:, 1][below[:, 1] != below[:, 0]]])
        promise = [self._surviving(tree, c, below) for c in tree.left[node]]
        for c in sorted((0, 1), key=lambda c: -promise[c][1].max(initial=0.0)):
            if len(promise[c][0]):
                self._visit(tree, tree.left[node][c], *promise[c])

    def _score(self, tree, node, own):
        """Exact scores of a leaf's documents with the items ``own``."""
        off, term, value, ids, missing = self.docs
        items = self.items
        docs = tree.order[tree.first[node]:tree.last[node]]
        at = _ranges(items.off[own], items.off[own + 1])
        whose = np.repeat(np.arange(len(own)), items.off[own + 1] - items.off[own])
        used = distinct(items.term[at])
        self.column[used] = np.arange(len(used))
        kind = np.float64 if items.exact else np.int64
        weights = np.zeros((len(used), len(own)), kind)
        weights[self.column[items.term[at]], whose] = items.weight[at]
        places = _ranges(off[docs], off[docs + 1])
        row = np.repeat(np.arange(len(docs)), off[docs + 1] - off[docs])
        column = self.column[term[places]]
        held = column >= 0
        matrix = np.zeros((len(docs), len(used)), kind)
        matrix[row[held], column[held]] = value[places[held]]
        self.column[used] = -1
        score = (matrix @ weights).astype(np.int64)
        self.scored += score.size
        good = score >= self.weakest[items.leaf[own]]
        for j in np.flatnonzero(good.any(axis=0)).tolist():
            new, item = docs[good[:, j]], int(own[j])
            old = self.best[item]
            s = np.concatenate([old[0], score[good[:, j], j]])
            d = np.concatenate([old[1], ids[new]])
            m = np.concatenate([old[2], missing[new]])
            order = np.lexsort((m, d, -s))[:self.k]
            self.best[item] = (s[order], d[order], m[order])
            if len(order) == self.k:
                node = items.leaf[item]
                self.weakest[node], self.late[node] = s[order[-1]], d[order[-1]]
                while items.parent[node] >= 0 and self._raise(items.parent[node]):
                    node = items.parent[node]

    def results(self) -> pa.RecordBatch:
        """(item, doc_id, score) of what is left, by the items' own places."""
        size = np.array([len(s) for s, _, _ in self.best], np.int64)
        item = np.repeat(self.items.order, size)
        score, ids, missing = (np.concatenate([b[k] for b in self.best]) if len(self.best) else np.zeros(0)
                               for k in range(3))
        return pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(ids.astype(np.int64), mask=missing.astype(bool)),
             pa.array(score.astype(np.int64))], ["item", "doc_id", "score"])


# ------------------------------------------------------------------ on Spark
def item_blocks(items: DataFrame, work: Workspace) -> list[DataFrame]:
    """The items in blocks of at most ``BLOCK_BYTES`` of text, or of one longer item."""
    items = work.stage(items.withColumn("_bytes", F.octet_length("text").cast("long")), "items")
    blocks = 1
    deal = lambda n: F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    while True:
        most = (items.groupBy(deal(blocks)).agg(F.sum("_bytes").alias("size"), F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > 1).agg(F.max("size")).first()[0])
        if most is None or most <= BLOCK_BYTES:
            return [items.where(deal(blocks) == b) for b in range(blocks)]
        blocks *= 2


def _document_terms(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with terms; the last two over the vocabulary."""
    width = max(len(vocabulary), 1)

    def run(batches):
        for batch in batches:
            for lo, hi, hashes, rows in term_hashes(batch.column(1)):
                n = np.diff(rows)
                at = np.searchsorted(vocabulary, hashes)
                known = np.flatnonzero(vocabulary[np.minimum(at, width - 1)] == hashes) if len(vocabulary) else at[:0]
                row = np.repeat(np.arange(hi - lo), n)[known]
                term, count, row = _counted(at[known], row, width)
                off = np.searchsorted(row, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n), binary_rows(term.astype(np.int32), off),
                     binary_rows(count.astype(np.int32), off)], ["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, terms binary, counts binary").where(F.col("n") > 0)


def _flat(column, kind=np.int32):
    """(values, offsets) of a binary column of packed integers."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    off = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, values.offset * 4).astype(np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    return data.view(kind), (off - off[0]) // np.dtype(kind).itemsize


def _statistics(terms: DataFrame, width: int) -> tuple[int, int, np.ndarray]:
    """(documents, terms with repeats, documents of every term): a partial sum a task, at most ``width`` + 2 rows."""
    def run(batches):
        total = np.zeros(width + 2, np.int64)
        for batch in batches:
            total[:width] += np.bincount(_flat(batch.column(1))[0], minlength=width)
            total[width] += batch.num_rows
            total[width + 1] += int(batch.column(0).to_numpy().sum())
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["at", "total"])

    sums = np.zeros(width + 2, np.int64)
    for r in (terms.select("n", "terms").mapInArrow(run, "at long, total long")
              .groupBy("at").agg(F.sum("total").alias("total")).collect()):
        sums[r["at"]] = r["total"]
    return int(sums[width]), int(sums[width + 1]), sums[:width]


def _searched(terms: DataFrame, items: Items, k: int, seed: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(item, doc_id, score): every task's k best of every item, none below the seed."""
    def run(batches):
        search = Search(items, k, seed)
        held: list = []

        def flush():
            if held:
                ids, missing, n, size, term, count = (np.concatenate(x) for x in zip(*held))
                held.clear()
                m = 50 + (50 * n * n_docs) // n_terms
                count = count.astype(np.int64)
                value = (1_000_000_000 * count) // (1000 * count + 20 * np.repeat(m, size))
                search.add(np.concatenate([[0], np.cumsum(size)]), term.astype(np.int64), value, ids, missing)

        for batch in batches:
            term, off = _flat(batch.column(2))
            count = _flat(batch.column(3))[0]
            ids = batch.column(0)
            missing = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool)
            ids = ids.fill_null(0).to_numpy()
            n = batch.column(1).to_numpy()
            lo = 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + TREE_TERMS, side="right")) - 1)
                held.append((ids[lo:hi], missing[lo:hi], n[lo:hi], np.diff(off[lo:hi + 1]),
                             term[off[lo]:off[hi]], count[off[lo]:off[hi]]))
                if sum(len(x[4]) for x in held) >= TREE_TERMS:
                    flush()
                lo = hi
        flush()
        yield search.results()

    return terms.select("doc_id", "n", "terms", "counts").mapInArrow(run, "item int, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest scores of every item.

    ``docs`` has doc_id and text, ``items`` item_id and text.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "lexical")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select("item_id", F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull()).distinct()
    kind = items.schema["item_id"].dataType.simpleString()
    parts = []
    for number, block in enumerate(item_blocks(items, work)):
        rows = block.select("item_id", "text").orderBy("item_id", "text").collect()  # of bounded size
        hashes = [(h, np.repeat(np.arange(hi - lo), np.diff(r)) + lo) for lo, hi, h, r in
                  term_hashes(pa.array([r["text"] for r in rows], pa.large_string()))]
        flat = np.concatenate([h for h, _ in hashes]) if hashes else np.zeros(0, np.uint64)
        whose = np.concatenate([w for _, w in hashes]) if hashes else np.zeros(0, np.int64)
        vocabulary, term = np.unique(flat, return_inverse=True)
        width = max(len(vocabulary), 1)
        terms = work.stage(_document_terms(docs, vocabulary), f"terms-{number}")
        n_docs, n_terms, df = _statistics(terms, width)
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) if x else 0
                           for x in df.tolist()], np.int64)
        term, _, row = _counted(term.ravel(), whose, width)
        live = weight[term] > 0  # the others add nothing to any score
        term, row = term[live], row[live]
        asked = np.unique(row)
        if not len(asked):  # no term of these items is in any document
            parts.append(spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long"))
            continue
        off = np.append(np.searchsorted(row, asked), len(row))
        block_items = Items(off, term, weight)
        seed = np.zeros(len(asked), np.int64)
        sample = terms.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(SEED)) == 0)
        for r in (_best(_searched(sample, block_items, k, seed, n_docs, n_terms), k)
                  .where(F.col("rank") == k).select("item", "score").collect()):  # one row an item of the block
            seed[r["item"]] = r["score"]
        best = _best(_searched(terms, block_items, k, seed, n_docs, n_terms), k)
        names = spark.createDataFrame([(i, rows[r]["item_id"]) for i, r in enumerate(asked.tolist())],
                                      f"item int, item_id {kind}")
        parts.append(work.stage(best.join(F.broadcast(names), "item")  # a block's items
                                .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"),
                                f"best-{number}"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return work.result(out)
