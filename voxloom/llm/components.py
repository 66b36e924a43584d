"""Connected components of a link table, on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import by_shuffle, saved


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links (a, b)``.

    Large-star and small-star steps in turn: each links all neighbours of a node to the smallest of them,
    which halves long chains.  Counts and minima are combined before the shuffle, and each round is
    written to the shared folder, so the lineage stays short.  Many links are joined by a shuffle.
    """
    edges = saved(links.filter("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    seen = _print(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(by_shuffle(least, 2 * seen[0]), "u").filter("v > u").select("v", "m")  # larger neighbours to the smallest
        large = large.filter("v <> m").distinct().select(F.col("m").alias("u"), "v")
        least = large.groupBy("v").agg(F.min("u").alias("m"))  # smaller neighbours, and the node, to the smallest
        small = large.join(by_shuffle(least, 2 * seen[0]), "v").select("u", "v", "m")
        small = small.filter("u <> m").select(F.col("m").alias("a"), F.col("u").alias("b")).union(
            least.select(F.col("m").alias("a"), F.col("v").alias("b"))).distinct()
        after = saved(small.select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
        # Stars have one centre per node and no node that is both: then nothing moves any more.
        now = _print(after)
        if now == seen:
            return after.select(F.col("v").alias("node"), F.col("u").alias("component"))
        edges, seen = after, now


def _print(edges: DataFrame) -> tuple:
    """Count and two order-free sums that tell edge sets apart."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(h % 1_000_003), F.bit_xor(h)).first())
