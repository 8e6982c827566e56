"""SentencePiece encoding and decoding in batched numpy, by distinct unit.

A text is normalised (identity), given the dummy prefix, and split into
units at places that no piece of the model spans: before a run of spaces,
and around characters that occur in no longer piece (line ends, say). Every
distinct unit is segmented once a worker. Units of equal length advance
together: hashes of all their substrings probe the sorted piece keys, and
vectorised maxima pick the pieces.

* Unigram models: Viterbi. Position by position, the best score of every
  prefix is the maximum over the pieces that end there, with backpointers.
* BPE models: a best-sum path is not what the model defines, so Viterbi
  gives wrong ids there. The same substring tables are used, but every
  step merges, in each unit, the adjacent pair whose joined piece scores
  highest (ties to the left), until none joins.

Characters outside the model become their bytes (byte fallback) or the
unknown id. Decoding gathers the pieces' bytes by id.

Defined cases: a null or empty text has no ids and decodes to ""; repeated
rows give repeated results; an empty table gives none; other columns are
ignored. U+2581 in a text stands for a space, as in the library.
"""

from __future__ import annotations

import heapq
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.llm.text import Memo, chunks, list_rows, trim

MARK = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
GROUP_CELLS = 1 << 21
#: Longer units are merged by a heap.
LONG_UNIT = 256


class Model:
    """The pieces of a model, ready for probing."""

    def __init__(self, pieces, scores, kinds, kind: int, dummy_prefix: bool = True):
        """pieces, scores, kinds by id; kind: UNIGRAM or BPE."""
        self.kind, self.dummy_prefix = kind, dummy_prefix
        self.pieces, self.kinds = list(pieces), np.array(kinds)
        self.unk = int(np.flatnonzero(self.kinds == UNKNOWN)[0])
        usable = [i for i, k in enumerate(kinds) if k in (NORMAL, USER, UNUSED)]
        self.longest = max(len(pieces[i]) for i in usable)
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.array([1] + [int(_BASE)] * self.longest, np.uint64))
        codes = [np.array([ord(c) for c in pieces[i]], np.uint64) for i in usable]
        keys = np.array([self._hash(c) for c in codes], np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces share a key")
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(usable)[order]
        self.scores = np.asarray(scores, np.float64)
        self.least = float(self.scores[usable].min()) - 10.0
        bytes_ = [i for i, k in enumerate(kinds) if k == BYTE]
        self.byte_ids = np.array(sorted(bytes_, key=lambda i: int(pieces[i][3:-1], 16))) if len(bytes_) == 256 else None
        inner = {c for i in usable if len(pieces[i]) > 1 for c in pieces[i]}
        # bytes that are characters of no longer piece: units break around them
        self.alone = np.array([b < 0x80 and b != 0x20 and chr(b) not in inner for b in range(256)])
        if any(MARK in pieces[i].lstrip(MARK) for i in usable):
            raise ValueError("a piece spans words; units can't be split at spaces")
        raw = [bytes([int(p[3:-1], 16)]) if k == BYTE else b"" if k == CONTROL else
               " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode() for p, k in zip(pieces, kinds)]
        self.raw_len = np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_len) - self.raw_len
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    @staticmethod
    def _hash(codes):
        total = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in codes:
                total = total * _BASE + c + np.uint64(1)
        return total

    # ------------------------------------------------------------ probing
    def _tables(self, codes: np.ndarray) -> np.ndarray:
        """ids[w, i, n - 1] of the piece codes[w, i:i+n], or -1."""
        words, length = codes.shape
        prefix = np.zeros((words, length + 1), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(length):
                prefix[:, i + 1] = prefix[:, i] * _BASE + codes[:, i] + np.uint64(1)
            top = min(self.longest, length)
            out = np.full((words, length, top), -1, np.int32)
            for n in range(1, top + 1):
                h = prefix[:, n:] - prefix[:, :length - n + 1] * self.power[n]
                at = np.minimum(np.searchsorted(self.keys, h.ravel()), len(self.keys) - 1)
                out[:, :length - n + 1, n - 1] = np.where(self.keys[at] == h.ravel(), self.ids[at], -1).reshape(h.shape)
        return out

    # ------------------------------------------------------- segmentation
    def _merge(self, codes, ids):
        """Symbol lengths at symbol starts (0 elsewhere), by best-first merges."""
        words, length = codes.shape
        top = ids.shape[2]
        size = np.ones((words, length), np.int64)
        before = np.tile(np.arange(-1, length - 1), (words, 1))
        pair = np.full((words, length), -np.inf)
        if length > 1 and top > 1:
            two = ids[:, :-1, 1]
            pair[:, :-1] = np.where(two >= 0, self.scores[two], -np.inf)
        live = np.arange(words)
        while len(live):
            best = pair[live].argmax(axis=1)
            ok = pair[live, best] > -np.inf
            live, best = live[ok], best[ok]
            if not len(live):
                break
            right = best + size[live, best]
            size[live, best] += size[live, right]
            size[live, right] = 0
            pair[live, right] = -np.inf
            after = best + size[live, best]
            inside = after < length
            before[live[inside], after[inside]] = best[inside]
            self._rescore(pair, ids, size, live, best, length, top)
            ahead = before[live, best]
            some = ahead >= 0
            self._rescore(pair, ids, size, live[some], ahead[some], length, top)
        return size

    def _merge_long(self, ids):
        """The same merges for one long unit, its pairs in a heap: n log n steps instead of n squared."""
        length, top = ids.shape
        size, before = [1] * length, list(range(-1, length - 1))
        heap: list = []

        def push(at):
            after = at + size[at]
            if after < length and size[at] + size[after] <= top:
                piece = ids[at, size[at] + size[after] - 1]
                if piece >= 0:
                    heap.append((-self.scores[piece], at, size[at], size[after]))
                    return True
            return False

        for i in range(length - 1):
            push(i)
        heapq.heapify(heap)
        while heap:
            _, at, left, right = heapq.heappop(heap)
            after = at + left
            if size[at] != left or after >= length or size[after] != right:
                continue  # one of the two has been merged since
            size[at], size[after] = left + right, 0
            after = at + size[at]
            if after < length:
                before[after] = at
            for symbol in (at, before[at]):
                if symbol >= 0 and push(symbol):
                    last = heap.pop()
                    heapq.heappush(heap, last)
        return np.array(size, np.int64)

    def _rescore(self, pair, ids, size, rows, at, length, top):
        """Score the symbol at ``at`` joined with the one after it."""
        after = at + size[rows, at]
        joined = size[rows, at] + np.where(after < length, size[rows, np.minimum(after, length - 1)], 0)
        fits = (after < length) & (joined <= top)
        piece = np.where(fits, ids[rows, at, np.minimum(joined, top) - 1], -1)
        pair[rows, at] = np.where(piece >= 0, self.scores[piece], -np.inf)

    def _viterbi(self, codes, ids):
        """Symbol lengths at symbol starts, by best-sum paths."""
        words, length = codes.shape
        top = ids.shape[2]
        best = np.full((words, length + 1), -np.inf)
        best[:, 0] = 0.0
        back = np.ones((words, length + 1), np.int64)
        for end in range(1, length + 1):
            for n in range(1, min(top, end) + 1):
                piece = ids[:, end - n, n - 1]
                score = np.where(piece >= 0, self.scores[piece], self.least if n == 1 else -np.inf)
                total = best[:, end - n] + score
                better = total > best[:, end]
                best[better, end] = total[better]
                back[better, end] = n
        size = np.zeros((words, length), np.int64)
        end = np.full(words, length)
        while (end > 0).any():
            rows = np.flatnonzero(end > 0)
            n = back[rows, end[rows]]
            end[rows] -= n
            size[rows, end[rows]] = n
        return size

    def segment(self, units: list[str]) -> list[np.ndarray]:
        """The ids of every unit; units of one length advance together."""
        out: list = [None] * len(units)
        by_length: dict = {}
        for k, u in enumerate(units):
            by_length.setdefault(len(u), []).append(k)
        for length, members in by_length.items():
            step = max(1, GROUP_CELLS // (length * min(self.longest, length)))
            for lo in range(0, len(members), step):
                own = members[lo:lo + step]
                codes = (np.frombuffer("".join(units[k] for k in own).encode("utf-32-le"), np.uint32)
                         .reshape(len(own), length).astype(np.uint64))
                ids = self._tables(codes)
                if self.kind == BPE and length > LONG_UNIT:
                    size = np.stack([self._merge_long(own_ids) for own_ids in ids])
                else:
                    size = (self._merge if self.kind == BPE else self._viterbi)(codes, ids)
                word, at = np.nonzero(size)
                piece = ids[word, at, size[word, at] - 1]
                bounds = np.searchsorted(word, np.arange(len(own) + 1))
                missing = np.flatnonzero(piece < 0)
                if not len(missing):
                    for j, k in enumerate(own):
                        out[k] = piece[bounds[j]:bounds[j + 1]]
                    continue
                lost = set(word[missing].tolist())
                for j, k in enumerate(own):
                    ids_ = piece[bounds[j]:bounds[j + 1]]
                    out[k] = self._fallback(units[k], at[bounds[j]:bounds[j + 1]], ids_) if j in lost else ids_
        return out

    def _fallback(self, unit, at, ids):
        out: list = []
        for i, piece in zip(at.tolist(), ids.tolist()):
            if piece >= 0:
                out.append(piece)
            elif self.byte_ids is not None:
                out.extend(self.byte_ids[list(unit[i].encode())].tolist())
            elif not out or out[-1] != self.unk:  # a run of unknown characters is one unknown
                out.append(self.unk)
        return np.array(out, np.int64)

    # ------------------------------------------------------------- decoding
    def decode(self, ids: np.ndarray, off: np.ndarray):
        """(bytes, offsets) of the texts of rows of ids, less the dummy prefix."""
        n = self.raw_len[ids]
        end = np.cumsum(n)
        index = np.repeat(self.raw_start[ids] - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)
        data = self.raw[index]
        rows = np.concatenate([[0], end])[off]
        if self.dummy_prefix:
            some = rows[:-1] < rows[1:]
            drop = rows[:-1][some]
            drop = drop[data[drop] == 0x20]
            keep = np.ones(len(data), bool)
            keep[drop] = False
            rows = rows - np.searchsorted(drop, rows)
            data = data[keep]
        return data, rows


def load(path: str) -> Model:
    """Read a SentencePiece model file."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    norm = m.normalizer_spec
    if m.trainer_spec.model_type not in (UNIGRAM, BPE) or norm.name != "identity" or norm.remove_extra_whitespaces:
        raise ValueError("only unigram and BPE models with identity normalisation are read")
    return Model([p.piece for p in m.pieces], [p.score for p in m.pieces], [p.type for p in m.pieces],
                 m.trainer_spec.model_type, norm.add_dummy_prefix)


_MODELS: dict = {}


def _model(path: str):
    if path not in _MODELS:
        model = load(path)
        memo = Memo(lambda spans: model.segment([s.decode("utf-8").replace(" ", MARK) for s in spans]), np.int32)
        _MODELS[path] = (model, memo)
        trim()  # what reading the file took
    return _MODELS[path]


def unit_bounds(data: np.ndarray, off: np.ndarray, alone: np.ndarray):
    """Starts and ends of the units of a run of rows, and each row's first."""
    fresh = np.zeros(len(data), bool)
    fresh[off[:-1][off[:-1] < len(data)]] = True
    space = data == 0x20
    fresh[1:] |= space[1:] & ~space[:-1]
    lone = alone[data]
    fresh |= lone
    fresh[1:] |= lone[:-1]
    starts = np.flatnonzero(fresh)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, off)


def encode_column(column, path: str):
    """Yield (first row, last row + 1, ids, offsets, bytes, byte offsets).

    The bytes are those that were encoded: U+2581 replaced by a space, and
    without the dummy prefix.
    """
    model, memo = _model(path)
    for lo, hi, data, off in chunks(column):
        if MARK.encode() in data.tobytes():
            plain = pc.replace_substring(column.slice(lo, hi - lo).cast(pa.large_string()), MARK, " ")
            [(_, _, data, off)] = list(chunks(plain, limit=1 << 62))
        body, body_off = data, off
        if model.dummy_prefix:
            some = np.flatnonzero(np.diff(off) > 0)
            data = np.insert(data, off[some], 0x20)
            off = off + np.searchsorted(some, np.arange(len(off)))
        starts, ends, rows = unit_bounds(data, off, model.alone)
        ids, count = memo.values(data, starts, ends)
        yield lo, hi, ids, np.concatenate([[0], np.cumsum(count)])[rows], body, body_off


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Every whole text's ids, and whether they decode to that text.

    Columns: doc_id, n_tokens, ids, n_chars (code points decoded) and
    round_trip (the decoded bytes equal the encoded text's).
    """

    def run(batches):
        model, _ = _model(path)
        for batch in batches:
            for lo, hi, ids, off, body, body_off in encode_column(batch.column(1), path):
                text, rows = model.decode(ids, off)
                chars = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                if np.array_equal(rows, body_off) and np.array_equal(text, body):
                    same = np.ones(hi - lo, bool)
                else:
                    same = np.array([np.array_equal(text[a:b], body[c:d]) for a, b, c, d in
                                     zip(rows[:-1], rows[1:], body_off[:-1], body_off[1:])], bool)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(off)), list_rows(ids, off, pa.int32()),
                     pa.array(np.diff(chars[rows])), pa.array(same)],
                    ["doc_id", "n_tokens", "ids", "n_chars", "round_trip"])
        trim()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, n_chars long, round_trip boolean"))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows of doc_id and ids; null ids give ""."""

    def run(batches):
        model, _ = _model(path)
        for batch in batches:
            lists = batch.column(1)
            lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            text, off = model.decode(ids, np.concatenate([[0], np.cumsum(size)]))
            raw = text.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([raw[a:b].decode("utf-8", "replace")
                                            for a, b in zip(off[:-1].tolist(), off[1:].tolist())], pa.string())],
                ["doc_id", "text"])

    return (rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
            .mapInArrow(run, "doc_id long, text string"))
