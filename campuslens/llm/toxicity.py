"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A text's features are its words and their character n-grams, hashed into
buckets. A bucket has an embedding; a text is the average of its features'
embeddings, and a linear softmax over two classes scores it. Embeddings and
softmax are trained jointly in numpy (mini-batches, Adagrad). An unseen
misspelling shares most n-grams with the word it comes from, so it scores
alike.

The model is fitted on at most ``TRAIN_DOCS`` labelled rows (those of the
smallest md5 of doc_id), which is what the driver holds; every whole text of
the table is scored, row by row in the tasks. As the score is linear in the
features, a distinct word needs its features only once a worker.

Defined cases: a null or empty text scores by the bias alone; labels that
are null, or rows without one, train nothing; several labels of a document
count once each; with no labelled rows, or one class only, the model
is its class prior; repeated rows score alike; an empty table gives none;
other columns are ignored.
"""

from __future__ import annotations

import binascii

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from campuslens.llm.text import LOWER, Memo, chunks, trim, word_bounds
from campuslens.llm.token_blocks import piece_cuts

TRAIN_DOCS = 6000
BUCKETS = 1 << 18
DIM = 4
GRAMS = (3, 4, 5)
EPOCHS = 9
RATE = 0.4
BATCH = 64
FOLDS = 5


def features(piece: bytes) -> list[int]:
    """Bucket numbers of a word and its character n-grams."""
    word = "<" + piece.decode("utf-8", "replace") + ">"
    out = [binascii.crc32(b"w" + piece) % BUCKETS]
    for n in GRAMS:
        out += [binascii.crc32(word[i:i + n].encode()) % BUCKETS for i in range(len(word) - n + 1)]
    return out


_FEATURES = Memo(lambda spans: [features(s) for s in spans], np.int32, limit=200_000)


def bags(column):
    """Yield (first row, buckets, offsets) of runs of rows: all features, repeats included."""
    for lo, _, data, off in chunks(column):
        low = LOWER[data]
        starts, ends, rows = word_bounds(low, off, piece_cuts(low))
        flat, count = _FEATURES.values(low, starts, ends)
        yield lo, flat, np.concatenate([[0], np.cumsum(count)])[rows]


class Model:
    """The score of every bucket and the bias, from the trained parts."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight.astype(np.float32), float(bias)

    def score(self, mean: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(mean + self.bias, -500, 500)))


def _packed(texts):
    """A batch's features by bucket: (row, share of the row, buckets, first place of each)."""
    bucket, row, value = [], [], []
    for lo, flat, off in bags(pa.array(texts, pa.large_string())):
        for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
            u, c = np.unique(flat[a:b], return_counts=True)
            bucket.append(u)
            row.append(np.full(len(u), lo + k, np.uint8))
            value.append((c / max(b - a, 1)).astype(np.float32))
    at = np.concatenate(bucket)
    by = np.argsort(at, kind="stable")
    unique, first = np.unique(at[by], return_index=True)
    return np.concatenate(row)[by], np.concatenate(value)[by], unique.astype(np.int32), first.astype(np.int32)


def fit(texts, labels, seed: int = 5) -> Model:
    """Train on a list of texts (None is empty) and labels 0 or 1."""
    y = np.asarray(labels, np.int64)
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    bias = float(np.log(prior / (1 - prior)))
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(BUCKETS), bias)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    embedding = (rng.uniform(-0.1, 0.1, (BUCKETS, DIM)) / DIM).astype(np.float32)
    softmax = (rng.standard_normal((DIM, 2)) * 0.1).astype(np.float32)
    constant = np.array([0.0, bias], np.float32)
    seen_e = np.full((BUCKETS, DIM), 1e-10, np.float32)
    seen_s, seen_c = np.full((DIM, 2), 1e-8), np.full(2, 1e-8)
    batches = []
    for lo in range(0, len(order), BATCH):
        own = order[lo:lo + BATCH]
        batches.append((own, *_packed([texts[i] for i in own])))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for own, row, val, unique, first in batches:
            if not len(row):
                continue
            width = np.diff(np.append(first, len(row)))
            part = embedding[np.repeat(unique, width)] * val[:, None]
            mean = np.stack([np.bincount(row, part[:, j], len(own)) for j in range(DIM)], axis=1)
            logit = mean @ softmax + constant
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(own)), y[own]] -= 1
            p /= len(own)
            back = (p @ softmax.T).astype(np.float32)
            g = np.add.reduceat(back[row] * val[:, None], first, axis=0)
            grad = mean.T @ p
            seen_e[unique] += g * g
            embedding[unique] -= rate * g / np.sqrt(seen_e[unique])
            seen_s += grad * grad
            softmax -= (rate * grad / np.sqrt(seen_s)).astype(np.float32)
            total = p.sum(axis=0)
            seen_c += total * total
            constant -= (0.1 * rate * total / np.sqrt(seen_c)).astype(np.float32)
    return Model(embedding @ (softmax[:, 1] - softmax[:, 0]), constant[1] - constant[0])


def train(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, most: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``most`` labelled documents; ``may_learn`` is a condition on doc_id."""
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    if may_learn is not None:
        labels = labels.where(may_learn)
    chosen = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
              .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "toxic").limit(most))
    rows = (docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(chosen), "doc_id")  # at most ``most`` small rows
            .dropDuplicates(["doc_id", "toxic", "text"])
            .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "toxic", "text").limit(most).collect())
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


_SCORERS: dict = {}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score and predicted (its own columns of these names give way)."""
    weight, bias = model.weight, model.bias
    key = binascii.crc32(weight.tobytes() + np.float64(bias).tobytes())
    docs = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    names, text_at = docs.columns, docs.columns.index("text")

    def run(batches):
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Memo(lambda spans: [[weight[f].sum(), len(f)] for f in map(features, spans)],
                                 np.float64)
        memo, own = _SCORERS[key], Model(weight, bias)
        for batch in batches:
            for lo, hi, data, off in chunks(batch.column(text_at)):
                low = LOWER[data]
                starts, ends, rows = word_bounds(low, off, piece_cuts(low))
                flat, _ = memo.values(low, starts, ends)
                total = np.concatenate([np.zeros((1, 2)), np.cumsum(flat.reshape(-1, 2), axis=0)])[rows]
                total = np.diff(total, axis=0)
                p = own.score(total[:, 0] / np.maximum(total[:, 1], 1))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    [*names, "score", "predicted"])
        trim()

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column = None) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 5, is 0."""
    doc_id = F.col("doc_id") if doc_id is None else doc_id
    return F.crc32(doc_id.cast("string")) % FOLDS == 0
