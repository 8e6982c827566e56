"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.session import stage


def _checksum(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, stage=stage) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge (a, b).

    Large-star links a node's larger neighbours to its smallest one,
    small-star its smaller ones; the edges end as stars around the smallest
    nodes. Every round is written to the shared folder, so lineage stays
    short (``stage`` says where). Minima are partial aggregates, and the joins back are on the node,
    where a hub is split by adaptive skew handling.
    """
    cut = lambda df: stage(df.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    edges = cut(edges.select("a", "b"))
    before = None
    while True:
        now = _checksum(edges)
        if now == before or now[0] == 0:
            break
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = cut(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .union(least.select("a", F.col("m").alias("b"))))
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).groupBy("node").agg(
        F.min("component").alias("component"))
