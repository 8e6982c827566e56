"""Approximate nearest neighbours: a forest of random-projection trees.

The forest's hyperplanes are fitted on a bounded sample (``sample`` rows,
those of the smallest key hashes); every row is indexed, in one leaf of
every tree. For the largest inner product, vectors get one more component
that lifts all to the largest norm, so that nearness in angle is nearness in
product.

All trees share one priority queue: a node's priority is the squared length
by which the query lies beyond the hyperplanes on the way to it, so it never
falls on the way down, and leaves leave the queue in the order of their
priorities. A block of queries drains its queues together: the priorities of
all nodes are passed down level by level as matrices, and every query opens
its leaves in order until they hold the share ``probe`` of all rows. Rows of
opened leaves are scored exactly, in double precision on the original
vectors; each shard keeps k results a query, merged by rank.

Without ``probe``, the share is measured: for some queries of the sample and
their true neighbours in it, it is the share at which ``target`` of the
neighbours' leaves are open. Nearly isotropic vectors (a 20th neighbour
hardly nearer than a 200th) need most of the rows, clustered ones few.

On Spark, rows are dealt into shards and queries into blocks, both of
bounded size; a row travels once a block, a query once a shard. Leaves grow
in number with the rows, up to an eighth of the sample a tree.

Defined cases: ``vectors.usable`` says which rows take part (zero vectors
do not); vectors meet only vectors of their own length, each of the
``FORESTS`` most frequent lengths in a forest of its own, all others in one
leaf (exhaustively); rows with the query's own id are no candidates; a
candidate repeated with the same id counts once, by its best score; of
queries that share an id, the smallest vector asks; equal scores go to the
smaller vec_id; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslens.llm.vectors import arrays, usable
from campuslens.llm.workspace import Workspace

TREES = 4
#: Rows of a leaf, sampled rows that a leaf is fitted on at least, and rows of the sample.
LEAF = 32
LEAF_SAMPLE = 8
SAMPLE = 32_768
#: Lengths that get a forest.
FORESTS = 16
TARGET = 0.95
CALIBRATE = 256
#: Components of a shard of rows and of a block of queries; rows of the smallest shard; pairs scored at once.
SHARD_VALUES = 1 << 20
BLOCK_VALUES = 1 << 18
SHARD_ROWS = 16_384
PAIRS = 1 << 22


class Tree:
    """Hyperplanes of one tree, parents before children; a child below 0 is leaf ``-child - 1``."""

    def __init__(self, x: np.ndarray, leaf: int, rng: np.random.Generator):
        self.normals: list = []
        self.offsets: list = []
        self.children: list = []
        self.leaves = 0
        self.root = self._grow(x, leaf, rng)
        self.normals = np.array(self.normals).reshape(-1, x.shape[1])
        self.offsets = np.array(self.offsets)
        self.children = np.array(self.children, np.int64).reshape(-1, 2)

    def _grow(self, x, leaf, rng):
        if len(x) > leaf:
            for _ in range(3):
                normal = rng.standard_normal(x.shape[1])
                at = x @ normal
                offset = float(np.median(at))
                right = at >= offset
                if right.any() and not right.all():
                    node = len(self.normals)
                    self.normals.append(normal / np.linalg.norm(normal))
                    self.offsets.append(offset / np.linalg.norm(normal))
                    self.children.append((0, 0))
                    self.children[node] = (self._grow(x[~right], leaf, rng), self._grow(x[right], leaf, rng))
                    return node
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), self.root)
        while True:
            inner = np.flatnonzero(at >= 0)
            if not len(inner):
                return -at - 1
            node = at[inner]
            margin = (x[inner] * self.normals[node]).sum(axis=1) - self.offsets[node]
            at[inner] = self.children[node, (margin >= 0).astype(np.int64)]

    def priorities(self, x: np.ndarray) -> np.ndarray:
        """(leaves, queries): the squared length beyond the hyperplanes on the way to every leaf."""
        out = np.zeros((self.leaves, len(x)))
        if self.root < 0:
            return out
        margin = self.normals @ x.T - self.offsets[:, None]
        node = np.zeros((len(self.children), len(x)))
        for i, pair in enumerate(self.children.tolist()):
            for child, beyond in zip(pair, (np.maximum(margin[i], 0), np.maximum(-margin[i], 0))):
                (node if child >= 0 else out)[child if child >= 0 else -child - 1] = node[i] + beyond * beyond
        return out


class Forest:
    def __init__(self, x: np.ndarray, trees: int, leaf: int, seed: int):
        rng = np.random.default_rng(seed)
        self.trees = [Tree(x, leaf, rng) for _ in range(trees)]
        self.first = np.cumsum([0, *[t.leaves for t in self.trees]])
        self.leaves = int(self.first[-1])

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree, numbered through the forest."""
        return np.stack([t.leaf_of(x) + self.first[i] for i, t in enumerate(self.trees)], axis=1)

    def shares(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """(queries, leaves): the share of all rows (``rows`` of every leaf) scored once a leaf has been opened."""
        priority = np.concatenate([t.priorities(x) for t in self.trees]).T
        order = np.argsort(priority, axis=1, kind="stable")
        opened = np.cumsum(rows[order], axis=1) / max(float(rows[:self.first[1]].sum()), 1.0)
        out = np.empty_like(opened)
        np.put_along_axis(out, order, opened, axis=1)
        return out

    def measured(self, x: np.ndarray, queries: np.ndarray, aimed: np.ndarray, k: int, target: float) -> float:
        """The share that opens ``target`` of the true neighbours of some queries among the rows ``x``."""
        at = self.leaves_of(x)
        rows = np.bincount(at.ravel(), minlength=self.leaves)
        needed = []
        for lo in range(0, len(queries), 32):
            score = aimed[lo:lo + 32] @ x.T
            score[np.arange(len(score)), queries[lo:lo + 32]] = -np.inf
            n = min(k, len(x) - 1)
            near = np.argpartition(-score, n - 1, axis=1)[:, :n]
            shares = self.shares(aimed[lo:lo + 32], rows)
            needed.append(np.min(np.take_along_axis(shares[:, None, :], at[near], axis=2), axis=2).ravel())
        return float(np.quantile(np.concatenate(needed), target)) if needed else 1.0


def lift(x: np.ndarray, largest: float) -> np.ndarray:
    """Rows with one more component, so that all have the largest norm."""
    rest = np.sqrt(np.maximum(largest ** 2 - (x * x).sum(axis=1), 0.0))
    return np.hstack([x, rest[:, None]])


def aim(x: np.ndarray, largest: float) -> np.ndarray:
    """Query rows at the largest norm, without a share in the added component."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.hstack([x * (largest / norm), np.zeros((len(x), 1))])


def _best(score: np.ndarray, ids: np.ndarray, k: int, unique: bool):
    """Places of a query's k best rows; of an id only its best one."""
    if unique and len(score) > 4 * k:
        kth = -np.partition(-score, k - 1)[k - 1]
        at = np.flatnonzero((score >= kth) & (score > -np.inf))
    else:
        at = np.flatnonzero(score > -np.inf)
    at = at[np.lexsort((ids[at], -score[at]))]
    if not unique:
        at = at[np.sort(np.unique(ids[at], return_index=True)[1])]
    return at[:k]


def score_shard(ids, x, leaves, query_ids, q, k: int, forest: Forest | None, largest: float, rows, probe: float):
    """Yield (query id, ids, scores) over one shard: rows of opened leaves, scored exactly."""
    unique = len(np.unique(ids)) == len(ids)
    by_tree = []
    for t in range(leaves.shape[1] if forest is not None else 0):
        order = np.argsort(leaves[:, t], kind="stable")
        start = np.flatnonzero(np.diff(leaves[order, t], prepend=-1))
        by_tree.append((order, leaves[order, t][start], start, np.append(start[1:], len(order))))
    size = max(1, PAIRS // max(len(ids), 1))
    for lo in range(0, len(q), size):
        asked, own = q[lo:lo + size], query_ids[lo:lo + size]
        if forest is None:
            score = asked @ x.T
        else:
            open_ = forest.shares(aim(asked, largest), rows)
            # a leaf is open if the share before it is below the probe
            open_ = open_ - rows[None, :] / max(float(rows[:forest.first[1]].sum()), 1.0) < probe
            score = np.full((len(asked), len(ids)), -np.inf)
            for order, leaf, start, end in by_tree:
                for n, s, e in zip(leaf.tolist(), start.tolist(), end.tolist()):
                    some = np.flatnonzero(open_[:, n])
                    if len(some):  # a row met in several trees has the same score each time
                        score[some[:, None], order[s:e][None, :]] = asked[some] @ x[order[s:e]].T
        score[own[:, None] == ids[None, :]] = -np.inf
        for i, row in zip(own.tolist(), score):
            at = _best(row, ids, k, unique)
            if len(at):
                yield i, ids[at], row[at]


def nearest(df: DataFrame, is_query: Column, k: int, key: str = "vec_id", column: str = "embedding",
            trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, probe: float | None = None,
            target: float = TARGET, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query row's k nearest found."""
    spark = df.sparkSession
    work = Workspace(spark, "nearest")
    width = F.size("vec").alias("d")
    rows = work.stage(usable(df, key, column, allow_zero=False).dropDuplicates().select("vec_id", "vec", width), "rows")
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    common = (rows.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("m"))
              .orderBy(F.desc("n"), "d").limit(FORESTS).collect())  # at most FORESTS rows
    forests = {}
    for r in common:
        if r["n"] <= 2 * leaf:
            continue
        own = max(sample * r["n"] // sum(c["n"] for c in common), 2 * LEAF_SAMPLE)
        fitted = (rows.where(F.col("d") == r["d"]).orderBy(F.xxhash64("vec_id"), "vec_id", "vec")
                  .limit(own).select("vec").toArrow())  # all lengths together: at most ``sample`` rows
        flat, _ = arrays(fitted.column("vec"))
        x, largest = flat.reshape(-1, r["d"]), math.sqrt(r["m"])
        lifted = lift(x, largest)
        forest = Forest(lifted, trees, max(LEAF_SAMPLE, leaf * len(x) // r["n"]), seed)
        some = np.linspace(0, len(x) - 1, min(CALIBRATE, len(x))).astype(np.int64)
        share = probe if probe is not None else forest.measured(lifted, some, aim(x[some], largest), k, target)
        forests[r["d"]] = (forest, largest, share)

    def index(batches):
        for batch in batches:
            d = batch.column("d").to_numpy()
            flat, lengths = arrays(batch.column("vec"))
            start, held = np.cumsum(lengths) - lengths, [None] * len(d)
            for n in np.unique(d).tolist():
                if n in forests:
                    mine = np.flatnonzero(d == n)
                    at = forests[n][0].leaves_of(lift(flat[start[mine][:, None] + np.arange(n)], forests[n][1]))
                    for i, leaves in zip(mine.tolist(), at.astype(np.int32)):
                        held[i] = leaves.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(held, pa.binary())], ["vec_id", "vec", "d", "leaves"])

    indexed = work.stage(rows.mapInArrow(index, "vec_id long, vec array<double>, d int, leaves binary"), "indexed")

    def count(batches):
        total: dict = {}
        for batch in batches:
            d = batch.column(0).to_numpy()
            for n in np.unique(d).tolist():
                if n in forests:
                    at = np.frombuffer(b"".join(batch.column(1).filter(pa.array(d == n)).to_pylist()), np.int32)
                    total[n] = total.get(n, 0) + np.bincount(at, minlength=forests[n][0].leaves)
        for n, rows_ in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows_), n, np.int32)), pa.array(np.arange(len(rows_))),
                                              pa.array(rows_)], ["d", "leaf", "n"])

    counts = {n: np.zeros(f.leaves, np.int64) for n, (f, _, _) in forests.items()}
    for r in (indexed.select("d", "leaves").mapInArrow(count, "d int, leaf long, n long")
              .groupBy("d", "leaf").agg(F.sum("n").alias("n")).collect()):  # a row a leaf
        counts[r["d"]][r["leaf"]] = r["n"]

    size = indexed.agg(F.sum("d").alias("values"), F.count(F.lit(1)).alias("n"),
                       F.sum(F.when(is_query, F.col("d"))).alias("asked")).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-(size["values"] or 0) // SHARD_VALUES), min(tasks, size["n"] // SHARD_ROWS))
    blocks = max(1, -(-(size["asked"] or 0) // BLOCK_VALUES))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "vec"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = (indexed.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec")).select("vec_id", "vec", width)
              .withColumn("block", deal(blocks)).withColumn("shard", every(shards)))
    held = indexed.withColumn("shard", deal(shards)).withColumn("block", every(blocks))

    def search(queries: pa.Table, table: pa.Table) -> pa.Table:
        out: list = [[], [], []]
        if queries.num_rows and table.num_rows:
            d = table.column("d")[0].as_py()
            forest, largest, share = forests.get(d, (None, 0.0, 1.0))
            ids = table.column("vec_id").to_numpy()
            x = arrays(table.column("vec"))[0].reshape(-1, d)
            asked = arrays(queries.column("vec"))[0].reshape(-1, d)
            at = (np.frombuffer(b"".join(table.column("leaves").to_pylist()), np.int32).reshape(len(ids), -1)
                  if forest is not None else np.zeros((len(ids), 0), np.int32))
            for i, best, score in score_shard(ids, x, at, queries.column("vec_id").to_numpy(), asked, k, forest,
                                              largest, counts.get(d), share):
                for column_, v in zip(out, (np.full(len(best), i), best, score)):
                    column_.append(v)
        kinds = (np.int64, np.int64, np.float64)
        return pa.Table.from_arrays([pa.array(np.concatenate(c).astype(t) if c else np.zeros(0, t))
                                     for c, t in zip(out, kinds)], ["query_id", "vec_id", "score"])

    key_ = ["d", "block", "shard"]
    found = (asking.groupBy(*key_).cogroup(held.groupBy(*key_))
             .applyInArrow(search, "query_id long, vec_id long, score double")
             .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return work.result(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                       .select("query_id", "rank", "vec_id", "score"))
