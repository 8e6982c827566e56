"""Upsert (``MERGE``) of a source frame into a target table by key.

Without a merge-capable table format the merge is expressed with joins.

**Full update** (every non-key column is overwritten on a match, the usual
case): the result is the target rows whose key is not in the source, plus
every source row. That is one left anti join on the source *keys* and a
union: the source rows themselves never take part in a join. When the
source has a proven and small row bound (a top-k load) its keys are broadcast, so the target, which grows with every load, is never
shuffled. Otherwise the anti join shuffles the target and the source keys
once each.

**Partial update** (some columns keep their target value on a match): a
full outer join on the key plus match markers. Markers (not ``coalesce``)
choose the side, because a matched row must be able to take a null from
the source.

In both forms a null key never matches: such source rows are inserted and
such target rows kept. In the outer-join form they bypass the join, since
otherwise every one of them would hash to the same shuffle partition. Both
sides are expected unique by key (``check_source_unique``), so there is no
hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from campuslens.functions.joins import CHECKED_BOUND

_S, _T = "_in_source", "_in_target"


def upsert(target: DataFrame, source: DataFrame, key: str,
           update_cols: list[str] | None = None,
           source_rows_bound: int | None = None) -> DataFrame:
    """Rows of ``target`` updated/inserted from ``source`` on ``key``.

    ``update_cols``: columns a match overwrites (default: every non-key
    column). ``source_rows_bound``: a proven upper bound on the source's
    rows (for example k for a top-k load); its keys are broadcast if the
    bound is at most ``CHECKED_BOUND``, and shuffled beyond it.
    Output has the target's columns in the target's order.
    """
    columns = target.columns
    non_key = [c for c in columns if c != key]
    if update_cols is None or set(update_cols) >= set(non_key):
        return _replace_by_key(target, source.select(*columns), key, source_rows_bound)
    return _merge_columns(target, source.select(*columns), key, update_cols)


def _replace_by_key(target: DataFrame, src: DataFrame, key: str, bound: int | None) -> DataFrame:
    keys = src.select(key).where(F.col(key).isNotNull())
    if bound is not None and bound <= CHECKED_BOUND:
        keys = F.broadcast(keys)
    return target.join(keys, key, "left_anti").unionByName(src)


def _merge_columns(target: DataFrame, src: DataFrame, key: str, update_cols: list[str]) -> DataFrame:
    columns = target.columns
    keyed = src.where(F.col(key).isNotNull()).withColumn(_S, F.lit(True))
    orphan = src.where(F.col(key).isNull())
    tgt = target.withColumn(_T, F.lit(True))

    s, t = keyed.alias("s"), tgt.alias("t")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    matched = F.col(f"s.{_S}").isNotNull()
    out = []
    for c in columns:
        if c == key:
            out.append(F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(matched, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col(f"t.{_T}").isNotNull(), F.col(f"t.{c}"))
                       .otherwise(F.col(f"s.{c}")).alias(c))
    return joined.select(*out).unionByName(orphan)


def check_source_unique(source: DataFrame, key: str) -> DataFrame:
    """Summary row: source rows, distinct keys, keys seen more than once, null keys."""
    per_key = source.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("rows"),
        F.count(F.col(key)).alias("distinct_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_key_rows"),
    )


def assert_source_unique(source: DataFrame, key: str, within: list[str] = ()) -> None:
    """Raise when a key occurs twice in the source (it would duplicate a target row).

    With ``within``, only repeats that agree on those columns count.
    """
    repeated = (source.where(F.col(key).isNotNull()).groupBy(key, *within).count()
                .where(F.col("count") > 1).limit(1).count())
    if repeated:
        raise ValueError(f"source has repeated {key} values; an upsert would duplicate target rows")


def latest_per_key(source: DataFrame, key: str, order_cols: list[str], within: list[str] | None = None,
                   repeats: Observation | None = None) -> DataFrame:
    """Keep one source row per key: the last by ``order_cols`` (e.g. page, pos).

    ``max_by`` on a struct is a partial aggregate, so a key repeated in a
    third of all rows still shuffles one row per partition. Null keys match
    nothing, so all their rows are kept.

    ``repeats`` observes, in the job that reads the result, the rows beyond
    the first of each key (of each key and ``within``) as ``rows``: the
    check needs no pass of its own. ``assert_no_repeats`` reads it.
    """
    others = [c for c in source.columns if c != key]
    latest = lambda df, *more: df.agg(
        F.max_by(F.struct(*others), F.struct(*order_cols)).alias("_row"), *more)
    keyed = source.where(F.col(key).isNotNull())
    if repeats is None:
        picked = latest(keyed.groupBy(key))
    else:
        count = F.count(F.lit(1)).alias("_rows")
        picked = latest(keyed.groupBy(key, *[F.col(c).alias(f"_in_{c}") for c in within or []]), count)
        picked = picked.observe(repeats, F.sum(F.col("_rows") - 1).alias("rows"))
        if within:
            last = F.struct(*[F.col("_row").getField(c) for c in order_cols])
            picked = picked.groupBy(key).agg(F.max_by("_row", last).alias("_row"))
    return (picked.select(key, "_row.*").select(*source.columns)
            .unionByName(source.where(F.col(key).isNull())))


def assert_no_repeats(repeats: Observation, key: str) -> None:
    """Raise if the observed source repeated a key (its upsert would duplicate a target row)."""
    if repeats.get.get("rows"):
        raise ValueError(f"source has repeated {key} values; an upsert would duplicate target rows")
