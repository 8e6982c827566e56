"""Token counts by section or field, by offset-mapped attribution.

A document is encoded once, as a whole. Byte-level tokens tile its UTF-8
bytes, so the running sum of the tokens' byte lengths gives every token's
span. The spans are interval-joined to the document's sections (spans that
tile it too) by binary search on the section starts. A token that crosses a
boundary is given out by an explicit rule:

* ``first``: to the section that holds its first byte;
* ``most``: to the section that holds most of its bytes, ties to the earlier;
* ``split``: to every section it touches, in proportion to the bytes there
  (the counts are then fractions and still sum to the document's tokens).

Encoding is row-local: no shuffle, and memory is bounded by a run of rows.

Defined cases: a null or empty text is one empty section 0 of no tokens; a
line end belongs to the line it ends, and a last line end opens no further
section; a null field is an empty section; repeated rows give repeated
results; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.llm.text import chunks

RULES = ("first", "most", "split")
_ENCODINGS: dict = {}


def _encoding(path: str, pattern: str):
    """The tokenizer of a rank file, and its tokens' byte lengths by id."""
    if path not in _ENCODINGS:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            lengths[i] = len(token)
        _ENCODINGS[path] = (tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}),
                            lengths)
    return _ENCODINGS[path]


def attribute(token_start, token_end, section_start, section_end, rule: str):
    """Tokens of each section and how many begin there and reach beyond it.

    Both lists of spans ascend and tile the same bytes; empty sections hold
    nothing. ``first`` and ``most`` count whole tokens.
    """
    n = len(section_start)
    if not len(token_start):
        return np.zeros(n), np.zeros(n, np.int64)
    first = np.searchsorted(section_start, token_start, side="right") - 1
    last = np.searchsorted(section_start, token_end - 1, side="right") - 1
    crossing = np.flatnonzero(first != last)
    crossed = np.bincount(first[crossing], minlength=n)
    if rule == "first" or not len(crossing):
        return np.bincount(first, minlength=n).astype(float), crossed
    whole = np.bincount(np.delete(first, crossing), minlength=n).astype(float)
    width = last[crossing] - first[crossing] + 1
    head = np.cumsum(width) - width
    token = np.repeat(crossing, width)
    section = np.repeat(first[crossing] - head, width) + np.arange(int(width.sum()))
    shared = np.maximum(np.minimum(token_end[token], section_end[section])
                        - np.maximum(token_start[token], section_start[section]), 0)
    if rule == "split":
        whole += np.bincount(section, shared / (token_end - token_start)[token], minlength=n)
    else:
        most = np.maximum.reduceat(shared, head)
        hit = np.flatnonzero(shared == np.repeat(most, width))
        owner = np.repeat(np.arange(len(crossing)), width)[hit]
        _, earliest = np.unique(owner, return_index=True)
        whole += np.bincount(section[hit[earliest]], minlength=n)
    return whole, crossed


def line_sections(data: np.ndarray, off: np.ndarray):
    """Starts of the lines of a run of rows, and each row's first section."""
    breaks = np.flatnonzero(data == 10) + 1
    breaks = breaks[~np.isin(breaks, off)]
    starts = np.concatenate([off[:-1], breaks])
    row = np.concatenate([np.arange(len(off) - 1), np.searchsorted(off, breaks, side="right") - 1])
    order = np.lexsort((starts, row))
    return starts[order], np.searchsorted(row[order], np.arange(len(off)))


def _count(data, off, sections, row_section, encoding, lengths, rule):
    """Counts of the sections of a run of rows (flat, in section order)."""
    raw = data.tobytes()
    bounds = off.tolist()
    ids = [encoding.encode_ordinary(raw[a:b].decode("utf-8")) for a, b in zip(bounds[:-1], bounds[1:])]
    flat = np.fromiter((i for row in ids for i in row), np.int64, sum(map(len, ids)))
    end = np.cumsum(lengths[flat])
    section_end = np.append(sections[1:], off[-1])
    return attribute(end - lengths[flat], end, sections, section_end, rule)


def _output(keys, data, off, sections, row_section, counts, crossed):
    section_end = np.append(sections[1:], off[-1])
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    n = np.diff(row_section)
    row = np.repeat(np.arange(len(n)), n)
    base = chars[off[row]]
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(row)), pa.array(np.arange(len(sections)) - row_section[row], pa.int32()),
         pa.array(chars[sections] - base), pa.array(chars[section_end] - base),
         pa.array(counts), pa.array(crossed, pa.int64())],
        ["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing"])


def section_token_counts(docs: DataFrame, ranks: str, pattern: str, rule: str = "first") -> DataFrame:
    """One row per line of every text, with its share of the whole text's tokens.

    Columns: doc_id, section (from 0), char_start, char_end (of the line with
    its line end, in code points), n_tokens (double under ``split``, else
    long) and n_crossing (tokens that begin in the line and end beyond it).
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches):
        encoding, lengths = _encoding(ranks, pattern)
        for batch in batches:
            for lo, hi, data, off in chunks(batch.column(1)):
                sections, row_section = line_sections(data, off)
                counts, crossed = _count(data, off, sections, row_section, encoding, lengths, rule)
                yield _output(batch.column(0).slice(lo, hi - lo), data, off, sections, row_section, counts, crossed)

    out = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
           .mapInArrow(run, "doc_id long, section int, char_start long, char_end long, "
                            "n_tokens double, n_crossing long"))
    return out if rule == "split" else out.withColumn("n_tokens", F.col("n_tokens").cast("long"))


def field_token_counts(rows: DataFrame, key: str, fields: list[str], ranks: str, pattern: str,
                       separator: str = "\n", rule: str = "first") -> DataFrame:
    """One row per field of every row: its share of the joined fields' tokens.

    The fields are joined by ``separator``, which belongs to the field before
    it. Columns as above (the key as doc_id) and ``field``.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    names = list(fields)

    def run(batches):
        encoding, lengths = _encoding(ranks, pattern)
        for batch in batches:
            columns = [batch.column(i + 1).to_pylist() for i in range(len(names))]
            parts = [[(c or "") + (separator if i < len(names) - 1 else "") for i, c in enumerate(row)]
                     for row in zip(*columns)]
            for start, stop, data, off in chunks(pa.array(["".join(p) for p in parts], pa.large_string())):
                size = np.array([[len(c.encode()) for c in p] for p in parts[start:stop]], np.int64)
                sections = (np.cumsum(size, axis=1) - size + off[:-1, None]).ravel()
                row_section = np.arange(stop - start + 1) * len(names)
                counts, crossed = _count(data, off, sections, row_section, encoding, lengths, rule)
                yield _output(batch.column(0).slice(start, stop - start), data, off, sections, row_section,
                              counts, crossed)

    out = (rows.select(F.col(key).cast("long").alias("doc_id"),
                       *[F.col(f).cast("string").alias(f"field_{i}") for i, f in enumerate(names)])
           .mapInArrow(run, "doc_id long, section int, char_start long, char_end long, "
                            "n_tokens double, n_crossing long"))
    named = F.array(*[F.lit(n) for n in names])
    out = out.withColumn("field", F.element_at(named, F.col("section") + 1))
    return out if rule == "split" else out.withColumn("n_tokens", F.col("n_tokens").cast("long"))
