"""Similarity join on word shingles by a token-group matrix.

Two documents link when their sets of five-word shingles have a Jaccard
similarity of at least 0.8 (``9 * shared >= 4 * (size + size)``). The work
is on distinct sets; equal sets are one class.

1. *Which shingles are shared.* Runs of rows send each distinct shingle once
   to its hash bucket; a shingle that several sets of the run hold is sent
   once with its count, so a very common one costs one entry a run. Buckets
   send back the shingles that at least two different sets hold, with their
   frequency. A set of n shingles with fewer than 0.8 n shared ones has no
   partner and is done.
2. *Groups.* The other sets are partitioned by their least shingle hash, a
   key that similar sets mostly share, into groups of bounded size.
3. *The matrix.* A group's row is the union of its members' shingles. A set
   must share one of its rarest shingles with a partner (the first
   n - ceil(0.8 n) + 1 in order of frequency as the larger set of a pair,
   n - ceil(8 n / 9) + 1 as the smaller), so pairs of groups are candidates
   when their unions meet there.
4. *Bound and open.* For a pair of groups, every set's overlap with the
   other group's whole union bounds its overlap with any member; the group
   is opened only for sets whose bound reaches the threshold, and there the
   exact overlaps are counted. A pair of groups returns a spanning forest
   of its links and the number of links of each set, not the pairs.
5. Components are contracted over all forests.

Shingles are known by 64-bit hashes, of which 48 bits and the bucket travel;
nothing else is approximate, and no candidate is capped.

Defined cases: a text of one to four words has its whole sequence as its
one shingle; a null or empty text has no shingle, a component of its own and
no links; a null doc_id keeps its row with a null component and takes no
part; rows that share a doc_id but not the set of shingles are documents of
their own (each links, and has its component, by its own text); rows equal
in both have equal results; repeated rows are kept; an empty table gives
none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.llm.components import components
from campuslens.llm.text import LOWER, binary_rows, chunks, forget, hash_spans, mix64, shingle_hashes, trim, word_bounds
from campuslens.llm.workspace import Workspace

SHINGLE = 5
GROUP_SETS = 256
GROUP_TOKENS = 1 << 20
EXPAND = 1 << 22
RUN_BYTES = 4 << 20
LOW48 = np.uint64((1 << 48) - 1)
MANY = np.uint32(0xFFFFFFFF)


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int = SHINGLE):
    """Sorted distinct shingle hashes of a run of rows: (flat, offsets)."""
    low = LOWER[data]
    starts, ends, rows = word_bounds(low, off)
    flat, off = shingle_hashes(hash_spans(low, starts, ends), rows, size)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((flat, row))
    flat, row = flat[order], row[order]
    fresh = np.ones(len(flat), bool)
    fresh[1:] = (flat[1:] != flat[:-1]) | (row[1:] != row[:-1])
    flat, row = flat[fresh], row[fresh]
    return flat, np.searchsorted(row, np.arange(len(off)))


def _signatures(flat, off):
    """One 64-bit hash a set, of its size and members."""
    n = np.diff(off)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(flat))])
        return mix64((total[off[1:]] - total[off[:-1]]) + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _bytes(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in table.column(name)), kind)


_RUN = ("bucket int, run long, sigs binary, owners binary, sizes binary, lo binary, hi binary, "
        "many_lo binary, many_hi binary, many_n binary, docs array<long>, all_sigs binary, all_sizes binary, "
        "shared_owner binary, shared_token binary, distinct_owner binary")


def _runs(docs: DataFrame, buckets: int) -> DataFrame:
    """Each run of rows as one row a bucket, and one (bucket -1) of what stays with the run."""
    names = [c.split()[0] for c in _RUN.split(", ")]

    def run(batches):
        forget()
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, data, off in chunks(batch.column(1), RUN_BYTES):
                key = (part << 32) + number
                number += 1
                flat, off = shingle_sets(data, off)
                n = np.diff(off)
                sig = np.where(n > 0, _signatures(flat, off), np.uint64(0))
                named = np.array([i is not None for i in ids[lo:hi]])
                _, first = np.unique(np.where(named, sig, np.uint64(0)), return_index=True)
                own = np.sort(first[(n[first] > 0) & named[first]])  # one row for each distinct set of the run
                row = np.repeat(own, n[own])
                at = np.repeat(off[own] - (np.cumsum(n[own]) - n[own]), n[own]) + np.arange(len(row))
                token = flat[at]
                bucket = ((token >> np.uint64(48)) % np.uint64(buckets)).astype(np.int64)
                code = (bucket.astype(np.uint64) << np.uint64(48)) | (token & LOW48)
                order = np.argsort(code, kind="stable")
                start = np.flatnonzero(np.append(True, code[order][1:] != code[order][:-1])) if len(code) else order
                count = np.diff(np.append(start, len(code)))
                many = np.zeros(len(code), bool)
                many[order] = np.repeat(count > 1, count)
                single = np.flatnonzero(~many)
                by = single[np.argsort(bucket[single], kind="stable")]  # by bucket, then row
                bounds = np.searchsorted(bucket[by], np.arange(buckets + 1))
                common = code[order][start][count > 1]
                common_n = count[count > 1].astype(np.uint32)
                common_bounds = np.searchsorted(common, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(48))
                out = {c: [] for c in names}
                for b in range(buckets):
                    mine = by[bounds[b]:bounds[b + 1]]
                    c0, c1 = common_bounds[b], common_bounds[b + 1]
                    if not len(mine) and c0 == c1:
                        continue
                    owner, size = np.unique(row[mine], return_counts=True)
                    _append(out, bucket=b, run=key, sigs=sig[owner].tobytes(), owners=owner.astype(np.uint32).tobytes(),
                            sizes=size.astype(np.uint32).tobytes(), lo=token[mine].astype(np.uint32).tobytes(),
                            hi=(token[mine] >> np.uint64(32)).astype(np.uint16).tobytes(),
                            many_lo=common[c0:c1].astype(np.uint32).tobytes(),
                            many_hi=(common[c0:c1] >> np.uint64(32)).astype(np.uint16).tobytes(),
                            many_n=common_n[c0:c1].tobytes())
                held = np.flatnonzero(many)
                _append(out, bucket=-1, run=key, docs=ids[lo:hi], all_sigs=sig.tobytes(),
                        all_sizes=n.astype(np.uint32).tobytes(), shared_owner=row[held].astype(np.uint32).tobytes(),
                        shared_token=code[held].tobytes(), distinct_owner=own.astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_pydict(out, schema=_SCHEMA)
        trim()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, _RUN))


_SCHEMA = pa.schema([(c.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(),
                                     "array<long>": pa.list_(pa.int64())}[c.split()[1]]) for c in _RUN.split(", ")])


def _append(out, **values):
    for c in out:
        out[c].append(values.get(c))


_SHARED = ("run long, owners binary, tokens binary, counts binary, docs array<long>, all_sigs binary, "
           "all_sizes binary, shared_owner binary, shared_token binary, distinct_owner binary")


def _shared_of_bucket(table: pa.Table) -> pa.Table:
    """What a bucket sends back to each run: its shared shingles and their frequency."""
    kept = ["run", "docs", "all_sigs", "all_sizes", "shared_owner", "shared_token", "distinct_owner"]
    if table.column("bucket")[0].as_py() < 0:
        empty = pa.nulls(table.num_rows, pa.binary())
        columns = {c: table.column(c) for c in kept} | dict.fromkeys(("owners", "tokens", "counts"), empty)
        return pa.table([columns[c.split()[0]] for c in _SHARED.split(", ")], names=[c.split()[0] for c in _SHARED.split(", ")])
    bucket = np.uint64(table.column("bucket")[0].as_py()) << np.uint64(48)
    per_row = lambda name, width: np.array([len(v.as_buffer()) // width for v in table.column(name)], np.int64)
    size = _bytes(table, "sizes", np.uint32)
    join = lambda lo, hi: _bytes(table, lo, np.uint32).astype(np.uint64) | (_bytes(table, hi, np.uint16).astype(np.uint64) << np.uint64(32))
    token = np.concatenate([join("lo", "hi"), join("many_lo", "many_hi")])
    single = int(size.sum())
    sig = np.concatenate([np.repeat(_bytes(table, "sigs", np.uint64), size), np.zeros(len(token) - single, np.uint64)])
    owner = np.concatenate([np.repeat(_bytes(table, "owners", np.uint32), size), np.full(len(token) - single, MANY)])
    weight = np.concatenate([np.ones(single, np.uint32), _bytes(table, "many_n", np.uint32)])
    rows = np.arange(table.num_rows, dtype=np.int32)
    line = np.concatenate([np.repeat(rows, per_row("lo", 4)), np.repeat(rows, per_row("many_lo", 4))])
    run = table.column("run")
    del table  # the arrays above are all that is needed of it
    order = np.argsort(token, kind="stable")
    token, weight = token[order], weight[order]
    sig = sig[order]
    start = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    width = np.diff(np.append(start, len(token)))
    shared = ((np.maximum.reduceat(weight, start) > 1)
              | (np.maximum.reduceat(sig, start) != np.minimum.reduceat(sig, start)))
    del sig
    total = np.add.reduceat(weight.astype(np.int64), start)
    keep = np.repeat(shared, width)
    back = order[keep]  # places in the unsorted order
    by = np.argsort(line[back], kind="stable")
    token, count = token[keep][by] | bucket, np.repeat(total, width)[keep][by].astype(np.uint32)
    owner, line = owner[back][by], line[back][by]
    bounds = np.searchsorted(line, np.arange(len(rows) + 1))
    some = np.flatnonzero(np.diff(bounds))
    del order, back, by
    trim()
    columns = {"run": run.take(pa.array(some)),
               "owners": binary_rows(owner, bounds).take(pa.array(some)),
               "tokens": binary_rows(token, bounds).take(pa.array(some)),
               "counts": binary_rows(count, bounds).take(pa.array(some))}
    names = [c.split()[0] for c in _SHARED.split(", ")]
    return pa.table([columns.get(c, pa.nulls(len(some), pa.list_(pa.int64()) if c == "docs" else pa.binary()))
                     for c in names], names=names)


_SETS = ("doc_id long, sig long, n long, least long, tokens binary, as_larger array<long>, as_smaller array<long>")


def _sets_of_run(table: pa.Table) -> pa.Table:
    """A run's rows again, with the shared shingles of the sets that can have a partner."""
    head = next(i for i, d in enumerate(table.column("docs")) if d.is_valid)
    one = lambda name, kind: np.frombuffer(table.column(name)[head].as_py(), kind)
    docs = table.column("docs")[head].as_py()
    sig, n = one("all_sigs", np.uint64), one("all_sizes", np.uint32).astype(np.int64)
    rest = table.filter(pc.is_valid(table.column("owners")))
    owner, token = _bytes(rest, "owners", np.uint32), _bytes(rest, "tokens", np.uint64)
    count = _bytes(rest, "counts", np.uint32)
    common = np.flatnonzero(owner == MANY)
    common = common[np.argsort(token[common])]
    held_owner, held = one("shared_owner", np.uint32), one("shared_token", np.uint64)
    held_count = count[common][np.searchsorted(token[common], held)] if len(held) else held.astype(np.uint32)
    alone = owner != MANY
    owner = np.concatenate([owner[alone], held_owner]).astype(np.int64)
    token, count = np.concatenate([token[alone], held]), np.concatenate([count[alone], held_count])
    shared = np.bincount(owner, minlength=len(n))
    open_ = (n > 0) & (5 * shared >= 4 * n)
    keep = open_[owner]
    owner, token, count = owner[keep], token[keep], count[keep]
    order = np.lexsort((token, count, owner))  # rarest first
    owner, token = owner[order], token[order]
    bounds = np.searchsorted(owner, np.arange(len(n) + 1))
    out: dict = {c.split()[0]: [] for c in _SETS.split(", ")}
    signed = sig.view(np.int64)
    has_set = set(one("distinct_owner", np.uint32).tolist())
    for i, doc in enumerate(docs):
        mine = token[bounds[i]:bounds[i + 1]]
        unique = int(n[i] - len(mine))
        live = bool(open_[i]) and i in has_set
        larger = mine[:max(int(n[i]) - -(-4 * int(n[i]) // 5) + 1 - unique, 0)] if live else None
        smaller = mine[:max(int(n[i]) - -(-8 * int(n[i]) // 9) + 1 - unique, 0)] if live else None
        _append(out, doc_id=doc, sig=int(signed[i]) if n[i] and doc is not None else None, n=int(n[i]),
                least=int(mix64(mine).min().view(np.int64)) if live else None,
                tokens=np.sort(mine).tobytes() if live else None,
                as_larger=larger.view(np.int64) if live else None,
                as_smaller=smaller.view(np.int64) if live else None)
    kinds = {"binary": pa.binary(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    return pa.table({c.split()[0]: pa.array(out[c.split()[0]], kinds[c.split()[1]]) for c in _SETS.split(", ")})


# ------------------------------------------------------- a pair of groups
def _links(a, b, same: bool):
    """Links between the sets of two groups as (index in a, index in b).

    A group is (sizes, flat shingles, offsets). Each set of ``a`` is bounded
    by its overlap with the union of ``b``; ``b`` is opened for those that
    reach the threshold. With ``same``, ``b`` is ``a`` and a pair comes once.
    """
    (na, fa, oa), (nb, fb, ob) = a, b
    by = np.argsort(fb, kind="stable")
    union, first = np.unique(fb[by], return_index=True)
    holder = np.repeat(np.arange(len(nb)), np.diff(ob))[by]
    last = np.append(first[1:], len(fb))
    row = np.repeat(np.arange(len(na)), np.diff(oa))
    at = np.minimum(np.searchsorted(union, fa), max(len(union) - 1, 0))
    hit = union[at] == fa if len(union) else np.zeros(len(fa), bool)
    row, at = row[hit], at[hit]
    bound = np.bincount(row, minlength=len(na))
    # the least overlap that a partner of an admissible size asks for
    sizes = np.sort(nb)
    low = np.searchsorted(sizes, -(-4 * na // 5))
    possible = low < len(sizes)
    need = -(-4 * (na + sizes[np.minimum(low, len(sizes) - 1)]) // 9)
    opened = possible & (bound >= need)
    keep = opened[row]
    row, at = row[keep], at[keep]
    width = last[at] - first[at]
    done = np.cumsum(width)
    found_a, found_b = [], []
    edges = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    stops = np.append(edges[1:], len(row))
    lo = 0
    while lo < len(edges):  # whole sets at a time, up to EXPAND places
        base = done[edges[lo] - 1] if edges[lo] else 0
        hi = max(lo + 1, int(np.searchsorted(done[stops - 1], base + EXPAND, side="right")))
        s, e = edges[lo], stops[hi - 1]
        w = width[s:e]
        place = np.repeat(first[at[s:e]] - (np.cumsum(w) - w), w) + np.arange(int(w.sum()))
        local = np.unique(row[s:e], return_inverse=True)
        shared = np.bincount(np.repeat(local[1], w) * len(nb) + holder[place],
                             minlength=len(local[0]) * len(nb)).reshape(-1, len(nb))
        x, y = np.nonzero(9 * shared >= 4 * (na[local[0]][:, None] + nb[None, :]))
        found_a.append(local[0][x])
        found_b.append(y)
        lo = hi
    x = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
    y = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
    return (x[x < y], y[x < y]) if same else (x, y)


def _forest(x, y, n):
    """Indexes of links that span the components of n nodes (union by path halving)."""
    parent = list(range(n))
    kept = []
    for i, (u, v) in enumerate(zip(x.tolist(), y.tolist())):
        while parent[u] != u:
            parent[u] = parent[parent[u]]
            u = parent[u]
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        if u != v:
            parent[v] = u
            kept.append(i)
            if len(kept) == n - 1:
                break
    return np.array(kept, np.int64)


def _open_pair(left: pa.Table, right: pa.Table) -> pa.Table:
    """Forest edges (a, b, 0) and link counts (a, null, links) of a pair of groups."""
    def group(t):
        flat = _bytes(t, "tokens", np.uint64)
        size = np.array([len(v.as_buffer()) // 8 for v in t.column("tokens")], np.int64)
        return t.column("rep").to_numpy(), t.column("copies").to_numpy(), (
            t.column("n").to_numpy(), flat, np.concatenate([[0], np.cumsum(size)]))

    names, kinds = ["a", "b", "links"], [pa.int64()] * 3
    if not left.num_rows:
        return pa.table([pa.array([], k) for k in kinds], names=names)
    rep, copies, a = group(left)
    if right.num_rows:
        rep_b, copies_b, b = group(right)
        x, y = _links(a, b, False)
        total = len(rep) + len(rep_b)
        rep, copies, y = np.concatenate([rep, rep_b]), np.concatenate([copies, copies_b]), y + len(rep)
    else:
        x, y = _links(a, a, True)
        total = len(rep)
    links = (np.bincount(x, copies[y], total) + np.bincount(y, copies[x], total)).astype(np.int64)
    span = _forest(x, y, total)
    some = np.flatnonzero(links)
    return pa.table([pa.array(np.concatenate([rep[x[span]], rep[some]])),
                     pa.concat_arrays([pa.array(rep[y[span]], pa.int64()), pa.nulls(len(some), pa.int64())]),
                     pa.array(np.concatenate([np.zeros(len(span), np.int64), links[some]]))], names=names)


def similarity_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, n_links) of every row.

    ``class_id`` is the smallest doc_id with the same set of shingles;
    ``n_links`` counts the other documents linked, copies included.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "shingles")
    stage = work.stage
    # four buckets a partition: a worker holds one bucket's shingles at a time
    buckets = min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 16)
    sets = stage(_runs(docs, buckets).groupBy("bucket", F.when(F.col("bucket") < 0, F.col("run")).alias("own"))
                 .applyInArrow(_shared_of_bucket, _SHARED)
                 .groupBy("run").applyInArrow(_sets_of_run, _SETS), "shingle-sets")
    classes = stage(sets.where(F.col("sig").isNotNull()).groupBy("sig")
                    .agg(F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("copies")), "shingle-classes")
    members = (sets.where(F.col("tokens").isNotNull())
               .withColumnRenamed("least", "key").dropDuplicates(["sig"]).drop("doc_id"))
    # a set is known by its signature: doc_ids may belong to several
    members = stage(members.join(classes.select("sig", "copies"), "sig").withColumn("rep", F.col("sig")), "shingle-members")
    # groups: the key, dealt further where it holds many sets or shingles
    sizes = (members.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.sum(F.length("tokens") / 8).alias("t"))
             .select("key", F.ceil(F.greatest(F.col("c") / GROUP_SETS, F.col("t") / GROUP_TOKENS)).alias("parts")))
    members = (members.join(sizes, "key")
               .withColumn("gid", F.xxhash64("key", F.pmod(F.xxhash64("sig"), F.col("parts")))))
    grouped = stage(members.select("gid", "rep", "copies", "n", "tokens", "as_larger", "as_smaller"), "shingle-groups")
    # rows of the matrix at the shingles that must meet
    matrix = lambda c: (grouped.select("gid", "n", F.explode(c).alias("token"))
                        .groupBy("token", "gid").agg(F.min("n").alias("least_n"), F.max("n").alias("most_n")))
    larger = matrix("as_larger").select("token", F.col("gid").alias("g"), F.col("most_n").alias("top"),
                                        F.col("least_n").alias("bottom"))
    meet = (matrix("as_smaller").join(larger, "token")
            .where((F.col("gid") != F.col("g")) & (F.col("least_n") <= F.col("top"))
                   & (5 * F.col("most_n") >= 4 * F.col("bottom")))
            .select(F.least("gid", "g").alias("l"), F.greatest("gid", "g").alias("r")).distinct())
    alone = grouped.groupBy("gid").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(
        F.col("gid").alias("l"), F.col("gid").alias("r"))
    pairs = stage(meet.union(alone), "shingle-pairs")
    body = grouped.select("gid", "rep", "copies", "n", "tokens")
    left = pairs.join(body.withColumnRenamed("gid", "l"), "l")
    right = (pairs.where("l <> r").join(body.withColumnRenamed("gid", "r"), "r")
             .select(*[F.col(c).alias(c) for c in left.columns]))
    found = stage(left.groupBy("l", "r").cogroup(right.groupBy("l", "r"))
                  .applyInArrow(_open_pair, "a long, b long, links long"), "shingle-links")
    joined = components(found.where(F.col("b").isNotNull()), stage)
    degree = found.where(F.col("b").isNull()).groupBy("a").agg(F.sum("links").alias("links"))
    linked = joined.join(classes, F.col("node") == F.col("sig")).select("node", "component", "rep")
    least = linked.groupBy("component").agg(F.min("rep").alias("least"))
    named = (classes.join(linked.select("node", "component").join(least, "component"), F.col("sig") == F.col("node"), "left")
             .join(degree, F.col("sig") == F.col("a"), "left")
             .select("sig", "rep", F.coalesce("least", "rep").alias("component"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return work.result(
        sets.select("doc_id", "n", "sig").join(named, "sig", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
                F.coalesce("rep", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
