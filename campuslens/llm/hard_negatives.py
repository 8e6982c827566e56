"""Hard negatives by exact threshold joins over an index cut by norms.

An anchor's positives are its best rows of the same label; a positive's
negatives are the best rows of another label whose score lies in a window
that the positive's score fixes. Both are threshold joins in the manner of
L2AP. A shard's dimensions are put in order of their weight. Against a
threshold, a vector's last dimensions stay out of the inverted index as long
as the norm over them, times the largest query norm, is below the threshold:
alone they cannot reach it (a vector all of whose dimensions stay out is
never met). Scores are accumulated over the posting lists, dimension by
dimension; a pair is dropped once its partial score and the product of both
remaining norms stay below its threshold; the dimensions left out are added
to the survivors only. The threshold begins where the scores of a few rows
put the last place of a window and is lowered, each time by twice as much,
until every window is full or the threshold is below the window.

On Spark, rows are dealt into shards and anchors into blocks, both of
bounded size; each block meets each shard once as a group, once for the
positives and once for the windows, and shards' results are merged by rank.

Defined cases: a row takes part if neither key, label nor vector is null and
every component is finite (zero vectors do); vectors meet only vectors of
their own length; rows equal in key, label and vector are one row; rows with
the anchor's own key are neither positives nor negatives; rows that share a
key only are anchors each on its own; equal scores go to the smaller vec_id;
an anchor without positives, or a positive without rows in its window, gives
nothing; an empty table gives none; other columns are ignored. Products
must fit 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslens.llm.vectors import arrays, usable
from campuslens.llm.workspace import Workspace

#: Components of the largest shard (8 MB) and block, and rows of the smallest shard.
SHARD_VALUES = 1 << 20
BLOCK_VALUES = 1 << 18
SHARD_ROWS = 1024
#: Pairs that a task scores at once, and steps in which dimensions are accumulated.
PAIRS = 1 << 20
STEPS = 8
#: Rows that a first threshold is taken from.
PROBE = 256
EXACT = float(1 << 52)


class Index:
    """One shard's vectors of one length, dimensions by falling weight."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        x = matrix[order].astype(np.float64)
        self.dims = np.argsort(-(x * x).sum(axis=0), kind="stable")
        x = x[:, self.dims]
        self.step = max(1, -(-x.shape[1] // STEPS))
        self.cuts = list(range(0, x.shape[1], self.step))
        self.tail = self._tails(x)
        self.norm = float(self.tail[0].max()) if len(x) else 0.0
        self.rows, self.columns = x, np.ascontiguousarray(x.T)
        self.whole = matrix[order][:, self.dims]

    def _tails(self, x: np.ndarray) -> np.ndarray:
        """Norms over the dimensions from each cut on, a little enlarged (they are bounds)."""
        part = np.stack([(x[:, c:c + self.step] ** 2).sum(axis=1) for c in self.cuts] + [np.zeros(len(x))])
        return np.sqrt(np.cumsum(part[::-1], axis=0)[::-1]) * (1 + 1e-9)

    def reaching(self, q: np.ndarray, whole: np.ndarray, least: np.ndarray):
        """(query, row, score) of every pair whose score is ``least`` of its query or more."""
        heads = self._tails(q)
        # a vector's first dimensions are indexed: until its rest cannot reach the lowest threshold
        indexed = (heads[0].max() * self.tail[:-1] >= least.min()).sum(axis=0)
        order = np.argsort(-indexed, kind="stable")
        lists = [int((indexed > k).sum()) for k in range(len(self.cuts))]
        columns, tail = self.columns[:, order[:lists[0]]], self.tail[:, order[:lists[0]]]
        partial = np.zeros((len(q), lists[0]))
        live = np.ones(partial.shape, bool)
        for k, n in enumerate(lists):
            dims = slice(self.cuts[k], self.cuts[k] + self.step)
            partial[:, :n] += q[:, dims] @ columns[dims, :n]
            live[:, :n] &= partial[:, :n] + heads[k + 1][:, None] * tail[k + 1, :n] >= least[:, None]
            if live.mean() < 0.25:
                break
        a, b = np.nonzero(live)
        score, b = partial[a, b], order[b]
        done = np.minimum(indexed[b], k + 1)
        for k in range(len(self.cuts)):  # what the index leaves out, for the surviving pairs
            dims = slice(self.cuts[k], self.cuts[k] + self.step)
            missing = np.flatnonzero(done <= k)
            for lo in range(0, len(missing), PAIRS // 8):
                at = missing[lo:lo + PAIRS // 8]
                score[at] += np.einsum("ij,ij->i", q[a[at], dims], self.rows[b[at], dims])
            done = np.maximum(done, k + 1)
            keep = score + heads[done, a] * self.tail[done, b] >= least[a]
            if not keep.all():
                a, b, score, done = a[keep], b[keep], score[keep], done[keep]
        if heads[0].max() * self.norm >= EXACT:  # beyond the integers that doubles hold
            score = (whole[a] * self.whole[b]).sum(axis=1)
        else:
            score = np.rint(score).astype(np.int64)
        keep = score >= least[a]
        return a[keep], b[keep], score[keep]

    def windows(self, ids, labels, matrix, spans, need: int, same: bool):
        """Yield (query, window, rows, scores): the ``need`` best of every window.

        ``spans`` holds for each query its windows as (lowest, highest) score,
        None for no limit. Rows must have the query's label (``same``) or
        another, and another id.
        """
        whole = matrix[:, self.dims]
        q = whole.astype(np.float64)
        if not len(self.ids):
            return
        probe = np.linspace(0, len(self.ids) - 1, min(PROBE, len(self.ids))).astype(np.int64)
        scores = q @ self.columns[:, probe]
        mean, spread = scores.mean(axis=1), scores.std(axis=1) + 1.0
        reach = np.sqrt((q * q).sum(axis=1)) * self.norm * (1 + 1e-9) + 1.0
        lowest = np.array([min((-np.inf if lo is None else lo) for lo, _ in s) for s in spans], np.float64)
        top = np.array([min((np.inf if hi is None else hi) for _, hi in s) for s in spans], np.float64)
        # where about twice the rows of a window are expected above, or just below its upper end
        above = mean + spread * np.sqrt(2 * np.log(max(len(self.ids) / (2.0 * need), 1.0)))
        start = np.minimum(np.where(np.isinf(top), above, top), reach)
        drop = spread / 16
        least = np.maximum(np.floor(start - drop), lowest)
        open_ = np.arange(len(q))
        size = max(1, PAIRS // len(self.ids))
        while len(open_):
            left = []
            for lo in range(0, len(open_), size):
                own = open_[lo:lo + size]
                a, b, s = self.reaching(q[own], whole[own], least[own])
                fits = (self.labels[b] == labels[own[a]]) == same
                fits &= self.ids[b] != ids[own[a]]
                a, b, s = a[fits], b[fits], s[fits]
                order = np.lexsort((b, -s, a))  # rows are in order of their ids
                a, b, s = a[order], b[order], s[order]
                ends = np.searchsorted(a, np.arange(len(own) + 1))
                for k, query in enumerate(own.tolist()):
                    found = self._filled(spans[query], b[ends[k]:ends[k + 1]], s[ends[k]:ends[k + 1]],
                                         least[query], reach[query], need)
                    if found is None:
                        left.append(query)
                    else:
                        yield from ((query, w, *f) for w, f in enumerate(found))
            open_ = np.array(left, np.int64)
            drop[open_] *= 2
            least[open_] = np.maximum(least[open_] - np.ceil(drop[open_]), np.maximum(lowest[open_], -reach[open_]))

    @staticmethod
    def _filled(spans, rows, scores, least, reach, need):
        """The rows of every window, or None while the threshold must come down."""
        out = []
        for lo, hi in spans:
            first = 0 if hi is None else int(np.searchsorted(-scores, -hi))
            last = len(scores) if lo is None else int(np.searchsorted(-scores, -lo, side="right"))
            last = min(max(last, first), first + need)
            if last - first < need and least > (-reach if lo is None else lo):
                return None
            out.append((rows[first:last], scores[first:last]))
        return out


def prepared(df: DataFrame, scale: int, key: str, column: str, label: str, relabel: Column | None) -> DataFrame:
    """(vec_id, vec, label, tag) of the rows that take part, each once.

    ``tag`` tells rows that share a key apart.
    """
    rows = usable(df.where(F.col(label).isNotNull()), key, column, True, F.col(label).cast("long").alias("label"))
    if relabel is not None:
        rows = rows.withColumn("label", relabel.cast("long"))
    rows = rows.withColumn("vec", F.transform("vec", lambda x: F.floor(F.lit(float(scale)) * x)))
    return rows.dropDuplicates().withColumn("tag", F.xxhash64("label", "vec"))


def _meet(asked: DataFrame, rows: DataFrame, shards: int, blocks: int, search, schema: str) -> DataFrame:
    """Every block of ``asked`` meets every shard of ``rows`` once."""
    spread = F.xxhash64("vec_id", "tag")
    deal = lambda n: F.pmod(spread, F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("block", deal(blocks)).withColumn("shard", every(shards))
    right = rows.withColumn("shard", deal(shards)).withColumn("block", every(blocks))
    return (left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(search, schema))


def _by_length(table: pa.Table):
    """{length: (places in the table, matrix)} of a table's vectors."""
    flat, lengths = arrays(table.column("vec"))
    start = np.cumsum(lengths) - lengths
    for d in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == d)
        yield d, own, flat[start[own][:, None] + np.arange(d)[None, :]].astype(np.int64)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _search(spans_of, need: int, same: bool):
    """The work of a group: yields (anchor's place, window, rows' ids, scores)."""
    def run(asked: pa.Table, rows: pa.Table):
        if not asked.num_rows or not rows.num_rows:
            return
        spans, ids, labels = spans_of(asked), _numbers(rows, "vec_id"), _numbers(rows, "label")
        asked_ids, asked_labels = _numbers(asked, "vec_id"), _numbers(asked, "label")
        found = {d: (own, m) for d, own, m in _by_length(rows)}
        for d, own, q in _by_length(asked):
            if d not in found or d == 0:
                continue
            place, matrix = found[d]
            # positives are searched among the rows of the label, negatives among all
            groups = [(own == own, np.ones(len(place), bool))] if not same else [
                (asked_labels[own] == x, labels[place] == x) for x in np.unique(asked_labels[own])]
            for asking, held in groups:
                index = Index(ids[place[held]], labels[place[held]], matrix[held]) if held.any() else None
                mine = own[asking]
                if index is None:
                    continue
                for k, w, at, score in index.windows(asked_ids[mine], asked_labels[mine], q[asking],
                                                     [spans[i] for i in mine.tolist()], need, same):
                    yield mine[k], w, index.ids[at], score
    return run


def _table(columns: dict) -> pa.Table:
    return pa.table({name: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64())
                     for name, v in columns.items()})


def hard_negatives(df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30,
                   high: int = 90, scale: int = 256, relabel: Column | None = None, key: str = "vec_id",
                   column: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id``, ``relabel`` a label from
    ``vec_id`` and ``label``; components are ``floor(scale * x)``. A negative's
    score is between ``low`` and ``high`` percent of the positive's.
    """
    spark = df.sparkSession
    work = Workspace(spark, "hard-negatives")
    rows = work.stage(prepared(df, scale, key, column, label, relabel), "rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_anchor, 1)).alias("q"),
                    F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("d")).first()
    width = max(size["d"], 1)
    # as many shards as tasks of a shuffle, between the smallest and the largest shard
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-size["n"] * width // SHARD_VALUES), min(tasks, size["n"] // SHARD_ROWS))
    blocks = max(1, -(-size["q"] * width // BLOCK_VALUES))
    anchors = rows.where(is_anchor)

    nearest = _search(lambda asked: [[(None, None)]] * asked.num_rows, positives, True)

    def best(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor_id", "anchor_tag", "vec_id", "score")}
        if asked.num_rows:
            ids, tags = _numbers(asked, "vec_id"), _numbers(asked, "tag")
            for k, _, at, score in nearest(asked, held):
                for c, v in zip(out, (np.full(len(at), ids[k]), np.full(len(at), tags[k]), at, score)):
                    out[c].append(v)
        return _table(out)

    found = _meet(anchors, rows, shards, blocks, best, "anchor_id long, anchor_tag long, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "anchor_tag").orderBy(F.desc("score"), F.asc("vec_id"))
    # at most ``positives`` windows an anchor
    spans = (found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
             .groupBy("anchor_id", "anchor_tag")
             .agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("spans")))
    asked = work.stage(anchors.join(spans, (F.col("vec_id") == F.col("anchor_id")) & (F.col("tag") == F.col("anchor_tag")))
                       .select("vec_id", "tag", "label", "vec", F.col("spans.vec_id").alias("positive_ids"),
                               F.col("spans.score").alias("positive_scores")), "anchors")

    def limits(table: pa.Table):
        scores = [v.as_py() for v in table.column("positive_scores")]
        return [[(-(-low * p // 100), high * p // 100) for p in row] for row in scores]

    inside = _search(limits, negatives, False)

    def window(asked_: pa.Table, held: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor_id", "anchor_tag", "place", "positive_id", "positive_score",
                               "negative_id", "negative_score")}
        if asked_.num_rows:
            ids, tags = _numbers(asked_, "vec_id"), _numbers(asked_, "tag")
            places, scores = ([v.as_py() for v in asked_.column(c)] for c in ("positive_ids", "positive_scores"))
            for k, w, at, score in inside(asked_, held):
                n = len(at)
                for c, v in zip(out, (np.full(n, ids[k]), np.full(n, tags[k]), np.full(n, w), np.full(n, places[k][w]),
                                      np.full(n, scores[k][w]), at, score)):
                    out[c].append(v)
        return _table(out)

    found = _meet(asked, rows, shards, blocks, window,
                  "anchor_id long, anchor_tag long, place long, positive_id long, positive_score long,"
                  " negative_id long, negative_score long")
    order = (Window.partitionBy("anchor_id", "anchor_tag", "place")
             .orderBy(F.desc("negative_score"), F.asc("negative_id")))
    return work.result(
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
