"""Document quality by a factorisation machine over words, structure and metadata.

A document's features are its distinct words (lower-cased, hashed into
buckets; together of length one), the bins of its structure statistics
(``STATISTICS``) and the bin of its metadata, the character count that comes
with it. The score is a logistic of a bias, a weight a feature and a product
of factors a pair of features. Pairs need no loop: the sum over all of them
is half of (the square of the sum of the factors minus the sum of their
squares), so a document costs as many steps as it has features. Weights and
factors are trained jointly in numpy (mini-batches, Adagrad); a bucket that
training never met stays without effect.

The model is fitted on at most ``TRAIN_DOCS`` labelled rows, in the order of
the md5 of doc_id, and on no more of them than have ``TRAIN_VALUES``
features together; features are taken in the tasks, and only they reach the
driver. Every whole text of the table is scored, row by row in the tasks.

Defined cases: a null or empty text has no words, and the statistics of an
empty text; without the column of the character count, or where it is null,
the metadata is unknown; labels that are null, or rows without one, train
nothing; several labels of a document count once each; with no labelled
rows, or one class only, the model is its class prior; repeated rows score
alike; an empty table gives none; other columns pass through (own ones
called score or predicted give way).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from campuslens.llm.text import LOWER, binary_rows, chunks, distinct, hash_spans, mix64, word_bounds
from campuslens.llm.workspace import Workspace

#: Bounds of the training sample: rows, and features of all of them (48 MB).
TRAIN_DOCS = 6000
TRAIN_VALUES = 4_000_000
WORDS = 1 << 16
FACTORS = 8
EPOCHS = 8
RATE = 0.15
DECAY = 2e-5
BATCH = 64
THRESHOLD = 0.3
BINS = 16
#: Bytes of letters, digits, prose marks and other marks.
_UPPER, _LETTER, _DIGIT, _PROSE, _MARK, _HIGH = (np.zeros(256, bool) for _ in range(6))
_UPPER[ord("A"):ord("Z") + 1] = True
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_DIGIT[ord("0"):ord("9") + 1] = True
_PROSE[[ord(c) for c in ".,;:?'\"()-"]] = True
_MARK[[c for c in range(0x21, 0x7F) if not (_LETTER[c] or _DIGIT[c] or _PROSE[c])]] = True
_HIGH[0x80:] = True
#: Structure statistics of a text, each put into ``BINS`` bins.
STATISTICS = ["words", "word length", "distinct words", "distinct pairs", "word repeated at once", "capitals",
              "digits", "prose marks", "other marks", "other scripts", "words a line", "words without letters",
              "words ending in a mark"]
META = WORDS + len(STATISTICS) * BINS
#: Bins of the character count, and one for an unknown count.
BUCKETS = META + 33


def _share(part, whole):
    return part / np.maximum(whole, 1)


def _fine(share):
    """Bins of a share, finer towards nothing (and, mirrored, nowhere else): nothing, 1/1024, ... 1."""
    return np.where(share <= 0, 0, np.clip(np.ceil(np.log2(np.maximum(share, 1e-9) * 1024) * 1.4) + 1, 1, BINS - 1))


def _even(share):
    return np.minimum(np.floor(share * (BINS - 1)), BINS - 1)


def _sizes(n):
    return np.minimum(np.floor(np.log2(n + 1.0)), BINS - 1)


def _statistics(data, off, starts, ends, rows, hashes, n_distinct) -> np.ndarray:
    """(rows, statistics) bin numbers of the texts of a chunk."""
    def total(flag, at):
        sums = np.zeros(len(flag) + 1, np.int32)
        np.cumsum(flag, out=sums[1:])
        return sums[at]

    by_byte = lambda kind: np.diff(total(kind[data], off))
    by_word = lambda flag: np.diff(total(flag, rows))
    n, size = np.diff(rows), np.diff(off)
    letters = total(_LETTER[data] | _HIGH[data], slice(None))
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[rows[:-1][rows[:-1] < len(same)]] = False  # a text's first word repeats nothing
    pair = hashes.copy()
    with np.errstate(over="ignore"):
        pair[1:] = mix64(hashes[:-1]) + hashes[1:]
    # 40 bits of a pair's hash beside its row: a chunk has fewer rows than 2^24
    pair = distinct((np.repeat(np.arange(len(n), dtype=np.uint64), n) << np.uint64(40)) | (pair >> np.uint64(24)))
    pairs = np.bincount((pair >> np.uint64(40)).astype(np.int64), minlength=len(n))
    return np.stack([
        _sizes(n), np.minimum(_share(by_word(ends - starts), n), BINS - 1).astype(np.int64),
        _even(_share(n_distinct, n)), _even(_share(pairs, n)), _fine(_share(by_word(same), n)),
        _fine(_share(by_byte(_UPPER), by_byte(_LETTER))), _fine(_share(by_byte(_DIGIT), size)),
        _fine(_share(by_byte(_PROSE), size)), _fine(_share(by_byte(_MARK), size)),
        _fine(_share(by_byte(_HIGH), size)), _sizes(_share(n, 1 + by_byte(np.arange(256) == 10))),
        _fine(_share(by_word(letters[ends] == letters[starts]), n)),
        _fine(_share(by_word(_MARK[data[ends - 1]]), n)),
    ], axis=1).astype(np.int64)


def features(texts, counts=None):
    """Yield (first row, last row + 1, buckets, values, offsets) of runs of rows.

    ``counts`` are the character counts that come with the texts (-1: unknown).
    """
    for lo, hi, data, off in chunks(texts):
        low = LOWER[data]
        starts, ends, rows = word_bounds(low, off)
        hashes = hash_spans(low, starts, ends)
        n = np.diff(rows)
        row = np.repeat(np.arange(hi - lo), n)
        key = distinct(row * WORDS + (hashes % np.uint64(WORDS)).astype(np.int64))
        n_distinct = np.bincount(key // WORDS, minlength=hi - lo)
        bins = _statistics(data, off, starts, ends, rows, hashes, n_distinct)
        own = np.full(hi - lo, -1.0) if counts is None else counts[lo:hi]
        meta = np.where(own < 0, 32, np.minimum(np.floor(np.log2(np.maximum(own, 0) + 1)), 31)).astype(np.int64)
        more = np.concatenate([WORDS + np.arange(len(STATISTICS)) * BINS + bins, (META + meta)[:, None]], axis=1)
        whose = np.concatenate([key // WORDS, np.repeat(np.arange(hi - lo), more.shape[1])])
        bucket = np.concatenate([key % WORDS, more.ravel()])
        value = np.concatenate([1 / np.sqrt(n_distinct[key // WORDS]), np.full(more.size, 0.5)])
        order = np.argsort(whose, kind="stable")
        yield (lo, hi, bucket[order].astype(np.int32), value[order].astype(np.float32),
               np.concatenate([[0], np.cumsum(n_distinct + more.shape[1])]))


class Model:
    """Bias, weights and factors of the buckets."""

    def __init__(self, bias: float, weight: np.ndarray, factor: np.ndarray):
        self.bias, self.weight, self.factor = float(bias), weight.astype(np.float32), factor.astype(np.float32)

    def logits(self, bucket, value, off) -> np.ndarray:
        """One step a feature: sums, and sums of squares, of the scaled factors."""
        if len(off) < 2:
            return np.zeros(0)
        part = self.factor[bucket] * value[:, None]
        sums = np.add.reduceat(part, off[:-1], axis=0, dtype=np.float64)
        squares = np.add.reduceat(part * part, off[:-1], axis=0, dtype=np.float64)
        line = np.add.reduceat(self.weight[bucket] * value, off[:-1], dtype=np.float64)
        return self.bias + line + 0.5 * (sums * sums - squares).sum(axis=1)

    def score(self, bucket, value, off) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(bucket, value, off), -500, 500)))


def fit(bags: list, labels, seed: int = 11) -> Model:
    """Train on (buckets, values) of documents and their labels 0 or 1."""
    y = np.asarray(labels, np.float64)
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    bias = float(np.log(prior / (1 - prior)))
    weight, factor = np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS))
    if len(y) == 0 or y.min() == y.max():
        return Model(bias, weight, factor)
    rng = np.random.default_rng(seed)
    factor = rng.normal(0, 0.05, (BUCKETS, FACTORS))
    seen_w, seen_v, seen_b = np.full(BUCKETS, 1e-4), np.full((BUCKETS, FACTORS), 1e-4), 1e-4
    met = np.zeros(BUCKETS, bool)
    order = rng.permutation(len(y))
    batches = []
    for lo in range(0, len(order), BATCH):
        own = order[lo:lo + BATCH]
        bucket = np.concatenate([bags[i][0] for i in own])
        row = np.repeat(np.arange(len(own)), [len(bags[i][0]) for i in own])
        by = np.argsort(bucket, kind="stable")
        unique, first = np.unique(bucket[by], return_index=True)
        met[unique] = True
        batches.append((own, row[by], np.concatenate([bags[i][1] for i in own])[by].astype(np.float64), unique, first))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for own, row, val, unique, first in batches:
            n = len(own)
            place = np.repeat(np.arange(len(unique)), np.diff(np.append(first, len(row))))
            w, v = weight[unique], factor[unique]
            part = v[place] * val[:, None]
            sums = np.stack([np.bincount(row, part[:, k], n) for k in range(FACTORS)], axis=1)
            squares = np.bincount(row, (part * part).sum(axis=1), n)
            logit = bias + np.bincount(row, w[place] * val, n) + 0.5 * ((sums * sums).sum(axis=1) - squares)
            g = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y[own])
            grad_w = np.add.reduceat(g[row] * val, first) / n + DECAY * w
            grad_v = np.add.reduceat((g[row] * val)[:, None] * (sums[row] - part), first, axis=0) / n + DECAY * v
            seen_w[unique] += grad_w ** 2
            seen_v[unique] += grad_v ** 2
            seen_b += g.mean() ** 2
            weight[unique] -= rate * grad_w / np.sqrt(seen_w[unique])
            factor[unique] -= rate * grad_v / np.sqrt(seen_v[unique])
            bias -= rate * g.mean() / np.sqrt(seen_b)
    factor[~met] = 0
    return Model(bias, weight, factor)


def _count_column(docs: DataFrame, column: str) -> Column:
    """The character count of a document, -1 where it is unknown."""
    return F.coalesce(F.col(column).cast("double"), F.lit(-1.0)) if column in docs.columns else F.lit(-1.0)


def _flags(docs: DataFrame, count: str) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), _count_column(docs, count).alias("n"))


def train(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, label: str = "quality",
          count: str = "n_chars") -> Model:
    """Fit on labelled documents within the bounds; ``may_learn`` is a condition on doc_id."""
    work = Workspace(docs.sparkSession, "quality")
    labels = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    if may_learn is not None:
        labels = labels.where(may_learn)
    draw = F.md5(F.col("doc_id").cast("string"))
    chosen = (labels.select("doc_id", F.col(label).cast("int").alias("label")).distinct()
              .orderBy(draw, "doc_id", "label").limit(TRAIN_DOCS))
    rows = (_flags(docs, count).join(F.broadcast(chosen), "doc_id")  # at most TRAIN_DOCS small rows
            .select("doc_id", "label", "text", "n"))

    def run(batches):
        for batch in batches:
            for lo, hi, bucket, value, off in features(batch.column(2), batch.column(3).to_numpy()):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(np.diff(off)),
                     binary_rows(bucket, off), binary_rows(value, off)], ["doc_id", "label", "size", "bucket", "value"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    bags = work.stage(rows.mapInArrow(run, f"doc_id {kind}, label int, size long, bucket binary, value binary")
                      .dropDuplicates(), "bags")
    order = [draw, "doc_id", "label", F.md5("bucket"), F.md5("value")]
    sizes = [r["size"] for r in bags.orderBy(*order).limit(TRAIN_DOCS).select("size").collect()]
    most = int(np.searchsorted(np.cumsum(sizes), TRAIN_VALUES, side="right"))
    held = bags.orderBy(*order).limit(max(most, min(1, len(sizes)))).select("label", "bucket", "value").collect()
    model = fit([(np.frombuffer(r["bucket"], np.int32), np.frombuffer(r["value"], np.float32)) for r in held],
                [r["label"] for r in held])
    work.drop()
    return model


def score(docs: DataFrame, model: Model, count: str = "n_chars") -> DataFrame:
    """``docs`` with score and predicted."""
    held = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    names, at = [f.name for f in held], len(held)  # the count goes along as a last column
    text_at = names.index("text")
    quoted = [F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(names)]
    asked = docs.select(*quoted, _count_column(docs, count).alias(f"c{at}"))

    def run(batches):
        for batch in batches:
            for lo, hi, bucket, value, off in features(batch.column(text_at), batch.column(at).to_numpy()):
                p = model.score(bucket, value, off)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns[:at], pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                    [*names, "score", "predicted"])

    return asked.mapInArrow(run, StructType([*held, StructField("score", DoubleType()),
                                             StructField("predicted", IntegerType())]))
