"""Exact top-k by integer inner product: MaxScore over shards of vectors.

A vector's components are its terms, a shard's vectors its documents. For a
query component of either sign a term's smallest contribution in the shard
is a constant, so scores are the sum of these constants plus non-negative
contributions, and a term's posting list holds the vectors that contribute
more than the constant. With the current k-th best score as threshold, the
terms are split: those of the smallest bounds whose bounds together cannot
reach the threshold are non-essential. Essential postings are traversed;
vectors they do not reach cannot compete; the others are probed in the
remaining terms, widest bound first, only while their bound competes. Each
shard keeps k results a query; the shards' results are merged by rank.

On Spark, queries are dealt into blocks and vectors into shards (both
counted first, so that either side of a group is bounded), each block meets
each shard once as a group, and the merge is a rank per query over k rows a
shard.

Defined cases: ``vectors.usable`` says which rows take part (zero vectors
do); vectors meet only vectors of their own length; rows with the query's
own id are no candidates; repeated rows count as often as they occur, and a
repeated query row once; equal scores go to the smaller vec_id; an empty
table gives none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslens.llm.vectors import arrays, by_length, usable

#: Components of the largest shard (16 MB) and block, and rows of the smallest shard.
SHARD_VALUES = 1 << 21
BLOCK_VALUES = 1 << 19
SHARD_ROWS = 1024
PROBE_TERMS = 8


class Shard:
    """Term-major integer vectors with bounds and posting lists of both signs."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.terms = ids[order], np.ascontiguousarray(matrix[order].T)
        self.least, self.most = self.terms.min(axis=1), self.terms.max(axis=1)
        self.lists: dict = {}

    def posting(self, term: int, positive: bool):
        """(vectors, their component) that contribute more than the constant."""
        if (term, positive) not in self.lists:
            x = self.terms[term]
            own = np.flatnonzero(x != (self.least if positive else self.most)[term])
            self.lists[term, positive] = (own, x[own])
        return self.lists[term, positive]

    def search(self, query_id: int, q: np.ndarray, k: int):
        """The k best (score, id), ties to the smaller id, without ``query_id``."""
        anchor = np.where(q > 0, self.least, self.most)
        base = int((q * anchor).sum())
        reach = np.abs(q) * (self.most - self.least)
        order = np.argsort(-reach, kind="stable")
        tail = np.append(np.cumsum(reach[order][::-1])[::-1], 0)  # bound of the terms from each place on
        own = self.ids != query_id
        live = np.flatnonzero(own)
        if len(live) <= k:
            return self._best(live, q, k)
        # a threshold from exact scores of a few vectors that lead in the widest term
        widest = self.terms[order[0]][live] * q[order[0]]
        lead = live[np.argpartition(-widest, min(4 * k, len(live) - 1))[:4 * k]]
        threshold = np.partition(q @ self.terms[:, lead], len(lead) - k)[len(lead) - k]
        essential = int(np.searchsorted(-(base + tail), -threshold, side="right"))  # first place whose rest can't reach it
        essential = min(max(essential, 1), len(order))
        score = np.full(len(self.ids), base, np.int64)
        reached = np.zeros(len(self.ids), bool)
        for term in order[:essential].tolist():
            if q[term]:
                at, x = self.posting(term, bool(q[term] > 0))
                score[at] += q[term] * (x - anchor[term])
                reached[at] = True
        if base + tail[essential] >= threshold:  # not even the rest can be ruled out alone
            reached[:] = True
        live = np.flatnonzero(reached & own & (score + tail[essential] >= threshold))
        score = score[live]
        for lo in range(essential, len(order), PROBE_TERMS):
            terms = order[lo:lo + PROBE_TERMS]
            score = score + q[terms] @ (self.terms[np.ix_(terms, live)] - anchor[terms][:, None])
            competing = score + tail[min(lo + PROBE_TERMS, len(order))] >= threshold
            live, score = live[competing], score[competing]
        return self._cut(self.ids[live], score, k)

    def _best(self, live, q, k):
        return self._cut(self.ids[live], q @ self.terms[:, live], k)

    @staticmethod
    def _cut(ids, score, k):
        order = np.lexsort((ids, -score))[:k]
        return ids[order], score[order]


def top_k(df: DataFrame, is_query: Column, k: int, key: str = "vec_id", column: str = "embedding",
          scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query row's k best vectors.

    ``is_query`` is a condition on ``vec_id``; components are
    ``floor(scale * x)``.
    """
    rows = (usable(df, key, column, allow_zero=True)
            .withColumn("vec", F.transform("vec", lambda x: F.floor(F.lit(float(scale)) * x))))
    queries = rows.where(is_query).dropDuplicates(["vec_id", "vec"])
    width = F.size("vec").cast("long")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("values"),
                    F.sum(F.when(is_query, width)).alias("asked")).first()
    # as many shards as tasks of a shuffle, between the smallest and the largest shard
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-(size["values"] or 0) // SHARD_VALUES), min(tasks, size["n"] // SHARD_ROWS))
    blocks = max(1, -(-(size["asked"] or 0) // BLOCK_VALUES))
    # rows are dealt by their place as well, so that copies of one row are spread
    deal = lambda n, *more: F.pmod(F.xxhash64("vec_id", "vec", *more), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("block", deal(blocks)).withColumn("shard", every(shards))
    right = (rows.withColumn("place", F.monotonically_increasing_id())
             .withColumn("shard", deal(shards, "place")).drop("place").withColumn("block", every(blocks)))

    def search(query_table: pa.Table, table: pa.Table) -> pa.Table:
        out: list = [[], [], []]
        if query_table.num_rows and table.num_rows:
            ids = table.column("vec_id").to_numpy()
            found = by_length(ids, *arrays(table.column("vec")))
            asked = by_length(query_table.column("vec_id").to_numpy(), *arrays(query_table.column("vec")))
            for d, (query_ids, matrix) in asked.items():
                if d in found:
                    shard = Shard(found[d][0], found[d][1].astype(np.int64))
                    for i, q in zip(query_ids.tolist(), matrix.astype(np.int64)):
                        best, score = shard.search(i, q, k)
                        for column_, v in zip(out, (np.full(len(best), i), best, score)):
                            column_.append(v)
        columns = [pa.array(np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64)) for c in out]
        return pa.Table.from_arrays(columns, ["query_id", "vec_id", "score"])

    found = (left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard"))
             .applyInArrow(search, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
