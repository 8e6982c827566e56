"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

Encoding runs on Spark in three steps, each over all rows:

1. ``encode`` turns every whole text into token ids (staged once);
2. the ids of all documents are counted, and an id's code is its rank by
   descending count (ties to the smaller id), so common ids take one byte;
3. the documents are range-partitioned and sorted by ``doc_id`` and packed
   into blocks. A block's payload is the magic ``TKB1``, the number of
   values as an unsigned 32-bit integer, then all control bytes (four 2-bit
   lengths each), then all data bytes.

Blocks are rows of a Parquet table (``blocks``) beside the rank table
(``vocab``), written by Spark's own writers, so that any executor and any
store can hold them. ``read_blocks`` decodes with numpy tables indexed by
the control byte.

Encoding is per piece: white space and the end of a run of letters are
always token boundaries of a tokenizer that splits words from punctuation
and drops white space, so every distinct piece is encoded by the library
once and looked up afterwards. Texts with a special token's opening
``<|`` are split at white space only and keep their case.

Defined cases: a null or empty text gives only the end id; a null doc_id
sorts first; repeated rows are kept and ordered by their ids' bytes; an
empty table gives empty files; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campuslens.llm.text import LOWER, Memo, binary_rows, chunks, word_bounds
from campuslens.session import scratch_path, stage

MAGIC = b"TKB1"
BLOCK_VALUES = 1 << 20
END_ID = 2

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
# Second bytes of the Latin-1 letters U+00C0-U+00FF (all but the two signs).
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False

# length table: bytes of each of the four values of a control byte;
# mask table: which of their 4 x 4 bytes are present.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
_MASKS = (np.arange(4)[None, None, :] < _LENGTHS[:, :, None]).reshape(256, 16)


# ---------------------------------------------------------------- the code
def pack(values: np.ndarray) -> bytes:
    """The payload of one block of unsigned 32-bit values."""
    v = np.asarray(values, np.uint32)
    code = (v >= 1 << 8).astype(np.uint8) + (v >= 1 << 16) + (v >= 1 << 24)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[:len(v)] = code
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    raw = v.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = raw[np.arange(4)[None, :] <= code[:, None]]
    return MAGIC + len(v).to_bytes(4, "little") + control.tobytes() + data.tobytes()


def unpack(payload: bytes) -> np.ndarray:
    """The values of a payload, by table lookup on its control bytes."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token block")
    n = int.from_bytes(payload[4:8], "little")
    groups = -(-n // 4)
    control = np.frombuffer(payload, np.uint8, groups, 8)
    present = _MASKS[control].reshape(-1)[:n * 4]
    out = np.zeros(n * 4, np.uint8)
    data = np.frombuffer(payload, np.uint8, offset=8 + groups)
    if len(data) != int(present.sum()):
        raise ValueError("token block of the wrong length")
    out[present] = data
    return out.view("<u4").astype(np.uint32)


# ------------------------------------------------------------- tokenizing
def piece_cuts(low: np.ndarray) -> np.ndarray:
    """Where ASCII punctuation follows an ASCII or Latin-1 letter."""
    after = _LETTER[low]
    after[1:] |= (low[:-1] == 0xC3) & _LATIN[low[1:]]
    cut = np.zeros(len(low), bool)
    cut[1:] = _PUNCT[low[1:]] & after[:-1]
    return cut


#: Pieces whose ids a worker remembers: about 60 MB.
KNOWN_PIECES = 1_000_000
_MEMOS: dict = {}


def _memo(path: str) -> Memo:
    if path not in _MEMOS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def compute(spans):
            encoded = tokenizer.encode_batch_fast([s.decode("utf-8") for s in spans], add_special_tokens=False)
            return [e.ids for e in encoded]

        _MEMOS[path] = Memo(compute, np.uint32, limit=KNOWN_PIECES)
    return _MEMOS[path]


def encode_column(column, path: str, end_id: int | None = END_ID):
    """Yield (first row, last row + 1, ids, offsets) for runs of rows."""
    memo = _memo(path)
    for lo, hi, data, off in chunks(column):
        if b"<|" in data.tobytes():
            starts, ends, rows = word_bounds(data, off)
            ids, count = memo.values(data, starts, ends, salt=1)
        else:
            low = LOWER[data]
            starts, ends, rows = word_bounds(low, off, piece_cuts(low))
            ids, count = memo.values(low, starts, ends)
        total = np.concatenate([[0], np.cumsum(count)])[rows]
        if end_id is not None:
            out = np.empty(len(ids) + len(off) - 1, np.uint32)
            row = np.repeat(np.arange(len(off) - 1), np.diff(total))
            out[np.arange(len(ids)) + row] = ids
            total = total + np.arange(len(total))
            out[total[1:] - 1] = end_id
            ids = out
        yield lo, hi, ids, total


def encode(docs: DataFrame, path: str, end_id: int | None = END_ID, id_bytes: int = 4) -> DataFrame:
    """(doc_id, ids): every whole text's token ids as little-endian integers."""
    kind = {2: np.uint16, 4: np.uint32}[id_bytes]

    def run(batches):
        for batch in batches:
            for lo, hi, ids, off in encode_column(batch.column(1), path, end_id):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), binary_rows(ids.astype(kind), off)], ["doc_id", "ids"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, ids binary"))


# ------------------------------------------------------------ writing files
def id_counts(encoded: DataFrame, vocab: int, id_bytes: int) -> DataFrame:
    """(id, count) of every id: partial counts per task, then one sum per id."""
    kind = np.dtype({2: "<u2", 4: "<u4"}[id_bytes])

    def run(batches):
        total = np.zeros(vocab, np.int64)
        for batch in batches:
            for value in batch.column(0):
                own = np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=vocab)
                if len(own) > vocab:
                    raise ValueError("an id is beyond the vocabulary")
                total += own
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["id", "count"])

    return (encoded.select("ids").mapInArrow(run, "id int, count long")
            .groupBy("id").agg(F.sum("count").alias("count")))


def write_blocks(docs: DataFrame, folder: str, tokenizer: str, vocab: int, end_id: int = END_ID) -> None:
    """Write ``docs`` as token files under ``folder`` (blocks and vocab).

    The rank table has at most ``vocab`` rows, whatever the input; that is
    what reaches the driver and travels with the tasks.
    """
    spark = docs.sparkSession
    id_bytes = 2 if vocab <= 1 << 16 else 4
    encoded = stage(encode(docs, tokenizer, end_id, id_bytes), "token-ids")
    counts = id_counts(encoded, vocab, id_bytes).collect()  # at most vocab rows
    number = np.zeros(vocab, np.int64)
    for r in counts:
        number[r["id"]] = r["count"]
    by_rank = np.lexsort((np.arange(vocab), -number))
    rank = np.empty(vocab, np.uint32)
    rank[by_rank] = np.arange(vocab, dtype=np.uint32)
    (spark.createDataFrame([(int(i), int(rank[i]), int(number[i])) for i in range(vocab)],
                           "id int, rank int, count long").coalesce(1).write.parquet(f"{folder}/vocab"))
    kind = np.dtype({2: "<u2", 4: "<u4"}[id_bytes])

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column(1)
            size = np.fromiter((len(v.as_buffer()) // kind.itemsize for v in ids), np.int64, len(ids))
            total = np.cumsum(size)
            lo = 0
            while lo < len(size):
                base = total[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(total, base + BLOCK_VALUES, side="right")))
                flat = np.concatenate([np.frombuffer(ids[i].as_buffer(), kind) for i in range(lo, hi)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(flat)], pa.int64()),
                     pa.array([batch.column(0).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                     pa.array([size[lo:hi].tolist()], pa.list_(pa.int64())),
                     pa.array([pack(rank[flat])], pa.binary())],
                    ["part", "seq", "n_values", "doc_ids", "sizes", "payload"])
                seq, lo = seq + 1, hi

    (encoded.repartitionByRange("doc_id", "ids").sortWithinPartitions("doc_id", "ids")
     .mapInArrow(run, "part int, seq int, n_values long, doc_ids array<long>, sizes array<long>, payload binary")
     .write.parquet(f"{folder}/blocks"))


def read_blocks(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens and ids (or their crc32).

    ``start`` counts the ids of all documents before it: block totals are
    summed within a partition, and partition totals (one row a written
    partition) over partitions.
    """
    ranked = spark.read.parquet(f"{folder}/vocab").orderBy("rank").select("id").collect()  # vocab rows
    of_rank = np.array([r["id"] for r in ranked], np.uint32)
    blocks = spark.read.parquet(f"{folder}/blocks")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("part", "seq", "doc_ids", "sizes")}
                ids = of_rank[unpack(batch.column("payload")[i].as_py())].astype("<u4")
                size = np.array(row["sizes"], np.int64)
                end = np.cumsum(size)
                n = len(size)
                off = np.concatenate([[0], end])
                raw = memoryview(ids.tobytes())
                own = (pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(off[:-1].tolist(), end.tolist())],
                                pa.int64()) if digest else list_of(ids, off))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(end - size), pa.array(size), own],
                    ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32" if digest else "ids"])

    def list_of(ids, off):
        return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.astype(np.int32)))

    column = "ids_crc32 long" if digest else "ids array<int>"
    docs = blocks.mapInArrow(run, f"part int, seq int, doc_id long, inside long, n_tokens long, {column}")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("part", "seq", "n_values")
    parts = (sizes.groupBy("part").agg(F.sum("n_values").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("part_start")))
    starts = (sizes.withColumn("inner_start", F.coalesce(
        F.sum("n_values").over(before.partitionBy("part").orderBy("seq")), F.lit(0)))
        .join(parts, "part")
        .select("part", "seq", (F.col("inner_start") + F.col("part_start")).alias("block_start")))
    return (docs.join(starts, ["part", "seq"])
            .select("doc_id", (F.col("inside") + F.col("block_start")).alias("start"), "n_tokens",
                    "ids_crc32" if digest else "ids"))


def token_files(docs: DataFrame, tokenizer: str, vocab: int, digest: bool = False) -> DataFrame:
    """Write ``docs`` to fresh token files and read them back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write_blocks(docs, folder, tokenizer, vocab)
    return read_blocks(spark, folder, digest)
