"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbed.llm.common import staged


def connected_components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the smallest reachable.

    Each round turns neighbourhoods into stars around their smallest node, once
    over all neighbours and once over the smaller ones; the number of rounds is
    logarithmic in the longest path. Only counts and a checksum come to the
    driver. Minima are partially aggregated, so a hub is one row per map task;
    adaptive execution splits its join. No links give no rows.
    """
    larger = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = links.filter(F.col("a") != F.col("b")).select(*larger).distinct()
    edges, before = staged(edges, "stars"), None
    for _ in range(max_rounds):
        if (now := _checksum(edges)) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        before = now
        edges = staged(_small_star(_large_star(edges)), "stars")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _checksum(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are tied to its smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = both.filter("v > u").join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, are tied to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least).distinct()
