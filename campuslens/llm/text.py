"""Byte-level helpers on Arrow text columns: splitting, hashing, memoising.

Everything here works on the UTF-8 bytes of a chunk of rows at once, so the
per-row and per-word work is numpy, not Python. White space is
``[\\x20\\x09-\\x0D]`` throughout.
"""

from __future__ import annotations

import ctypes
import weakref

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 2 << 20
LONG_WORD = 4096

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes over which one run of prefix sums reaches.
SEGMENT = 1 << 18
_P = 0x9E3779B97F4A7C15
with np.errstate(over="ignore"):
    _POW = np.cumprod(np.full(SEGMENT, _P, np.uint64))
    _UNPOW = np.ones(SEGMENT + 1, np.uint64)
    _UNPOW[1:] = np.cumprod(np.full(SEGMENT, pow(_P, -1, 1 << 64), np.uint64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (shift, multiply, shift)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values in order, by one sort."""
    x = np.sort(x)
    fresh = np.ones(len(x), bool)
    fresh[1:] = x[1:] != x[:-1]
    return x[fresh]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    buffers = a.buffers()
    off = (np.frombuffer(buffers[1], np.int64, len(a) + 1, a.offset * 8)
           if len(a) else np.zeros(1, np.int64))
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and off[-1] > 0 else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(column, limit: int = CHUNK_BYTES):
    """Yield (first row, last row + 1, bytes, offsets) of runs of whole rows.

    A run holds at most ``limit`` bytes, or one longer row.
    """
    data, off = utf8(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def spans(inside: np.ndarray, off: np.ndarray, cut: np.ndarray | None = None):
    """Starts and ends of the runs of ``inside`` bytes of a chunk, and each row's first run.

    ``cut`` marks bytes inside a run that begin a new one.
    """
    fresh = np.ones(len(inside), bool)
    fresh[1:] = ~inside[:-1]
    fresh[off[:-1][off[:-1] < len(inside)]] = True
    if cut is not None:
        fresh |= cut
    starts = np.flatnonzero(inside & fresh)
    done = np.ones(len(inside), bool)
    done[:-1] = ~inside[1:] | fresh[1:]
    ends = np.flatnonzero(inside & done) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_bounds(data: np.ndarray, off: np.ndarray, cut: np.ndarray | None = None):
    """Starts and ends of the words of a chunk, and each row's first word.

    ``cut`` marks bytes inside a word that begin a new piece.
    """
    return spans(~SPACE[data], off, cut)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; a function of the span's bytes alone.

    A span's hash is a polynomial in an odd base, read off prefix sums over
    the bytes: the difference of two sums, times the inverse power of the
    span's place (an odd base has one modulo 2^64).
    """
    if len(starts) and (np.diff(starts) < 0).any():
        order = np.argsort(starts, kind="stable")
        out = np.empty(len(starts), np.uint64)
        out[order] = hash_spans(data, starts[order], ends[order])
        return out
    lens = ends - starts
    out = np.empty(len(starts), np.uint64)
    long = np.flatnonzero(lens > LONG_WORD)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(starts):
            base = int(starts[lo])
            hi = int(np.searchsorted(starts, base + SEGMENT - LONG_WORD, side="right"))
            part = data[base:base + SEGMENT]
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * _POW[:len(part)], out=total[1:])
            s, e = starts[lo:hi] - base, np.minimum(ends[lo:hi] - base, len(part))
            out[lo:hi] = mix64((total[e] - total[s]) * _UNPOW[s] + lens[lo:hi].astype(np.uint64))
            lo = hi
    for i in long:
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    return out


def _sequence_hashes(words: np.ndarray, at: np.ndarray | None, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from every place of ``at`` on, or from every place where so many follow."""
    with np.errstate(over="ignore"):
        total = np.full(len(words) - size + 1 if at is None else len(at), size, np.uint64)
        for k in range(size):
            total *= np.uint64(0x9E3779B97F4A7C15)
            total += words[k:k + len(total)] if at is None else words[at + k]
            total = mix64(total)
    return total


def shingle_hashes(words: np.ndarray, row_words: np.ndarray, size: int):
    """Hashes of the ``size``-word shingles of every row, in text order.

    A row of 1..size-1 words has its whole sequence as one shingle; a row
    without words has none. Returns (hashes, each row's first shingle).
    """
    n = np.diff(row_words)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    off = np.concatenate([[0], np.cumsum(count)])
    start = np.repeat(row_words[:-1] - off[:-1], count) + np.arange(off[-1])
    if len(words) >= size:  # those that reach beyond their row are overwritten
        out = _sequence_hashes(words, None, size)[np.minimum(start, len(words) - size)]
    else:
        out = np.empty(len(start), np.uint64)
    for k in range(1, size):
        short = np.flatnonzero(n == k)
        if len(short):
            out[off[short]] = _sequence_hashes(words, row_words[short], k)
    return out, off


_MEMOS: weakref.WeakSet = weakref.WeakSet()


_LIBC = ctypes.CDLL(None)


def trim() -> None:
    """Give freed memory back: a worker that idles after its task keeps no arrays of it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def forget() -> None:
    """Empty every memo of this worker: an operator that has none makes room for its own arrays."""
    for memo in list(_MEMOS):
        memo.clear()
    trim()


class Memo:
    """Values of distinct byte spans, computed once a worker.

    ``compute(list[bytes])`` gives one value array for each span (token ids,
    feature sums). Spans are known by their 64-bit hash, probed in an
    open-address table of which at most half is used. Beyond ``limit`` spans
    the memo starts anew, so its memory is bounded.
    """

    def __init__(self, compute, dtype, limit: int = 400_000):
        self.compute, self.dtype, self.limit = compute, dtype, limit
        self.clear()
        _MEMOS.add(self)

    def clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int32)
        self.count = np.zeros(0, np.int32)
        self.flat = np.zeros(0, self.dtype)
        self._table(1 << 14)

    def _table(self, slots: int):
        self.slot_key, self.slot_at = np.zeros(slots, np.uint64), np.zeros(slots, np.int32)
        self._place(self.keys, 0)

    def _place(self, keys, first):
        mask = np.uint64(len(self.slot_key) - 1)
        at, slot = np.arange(first, first + len(keys), dtype=np.int32), (keys & mask).astype(np.int64)
        while len(keys):
            free = self.slot_key[slot] == 0
            self.slot_key[slot[free]] = keys[free]
            done = self.slot_key[slot] == keys
            self.slot_at[slot[done]] = at[done]
            keys, at = keys[~done], at[~done]
            slot = (slot[~done] + 1) & int(mask)

    def _find(self, hashes):
        """Place of every hash among the known ones, -1 if it is new."""
        mask = len(self.slot_key) - 1
        slot = (hashes & np.uint64(mask)).astype(np.int64)
        key = self.slot_key[slot]
        at = np.where(key == hashes, self.slot_at[slot], -1)
        left = np.flatnonzero((key != hashes) & (key != 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & mask
            key = self.slot_key[slot]
            hit = key == hashes[left]
            at[left[hit]] = self.slot_at[slot[hit]]
            on = ~hit & (key != 0)
            left, slot = left[on], slot[on]
        return at

    def _add(self, keys, spans):
        values = self.compute(spans)
        count = np.fromiter(map(len, values), np.int64, len(values))
        flat = np.concatenate([np.asarray(v, self.dtype) for v in values]) if len(values) else self.flat[:0]
        start = len(self.flat) + np.cumsum(count) - count
        width = np.int64 if len(self.flat) + len(flat) > 1 << 31 else np.int32
        self.start = np.concatenate([self.start, start.astype(width)])
        self.count = np.concatenate([self.count, count.astype(np.int32)])
        self.flat = np.concatenate([self.flat, flat])
        first = len(self.keys)
        self.keys = np.concatenate([self.keys, keys])
        if 2 * len(self.keys) > len(self.slot_key):
            self._table(1 << (2 * len(self.keys)).bit_length())
        else:
            self._place(keys, first)

    def values(self, data, starts, ends, salt: int = 0):
        """(flat values, values of each span) for the spans of a chunk."""
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        hashes = hash_spans(data, starts, ends)
        if salt:
            hashes = mix64(hashes + np.uint64(salt))
        hashes[hashes == 0] = 1
        at = self._find(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            uniq, first = np.unique(hashes[new], return_index=True)
            if len(self.keys) + len(uniq) > self.limit and len(self.keys):
                self.clear()
                new = np.arange(len(hashes))
                uniq, first = np.unique(hashes, return_index=True)
            own = new[first]
            self._add(uniq, [data[s:e].tobytes() for s, e in zip(starts[own].tolist(), ends[own].tolist())])
            at[new] = self._find(hashes[new])
        count = self.count[at].astype(np.int64)
        done = np.cumsum(count)
        index = np.repeat(self.start[at] - (done - count), count) + np.arange(int(done[-1]))
        return self.flat[index], count


def binary_rows(flat: np.ndarray, off: np.ndarray) -> pa.Array:
    """A binary Arrow column whose row i is flat[off[i]:off[i+1]]'s bytes."""
    width = flat.dtype.itemsize
    offsets = (np.asarray(off, np.int64) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1,
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def list_rows(flat: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list Arrow column whose row i is flat[off[i]:off[i+1]]."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(off, np.int32)), pa.array(flat, kind))
