"""Connected components of a graph given by its links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.session import settle


def components(links: DataFrame, u: str, v: str, label: str) -> DataFrame:
    """``node, root`` for every node of a link; ``root`` is the smallest node reachable.

    A round hangs each node's larger neighbours, then its smaller ones, on its smallest
    neighbour, so that paths shorten by a constant factor; it ends when a round changes nothing.
    Only minima are aggregated (before the shuffle as well). They are settled, so that the joins
    with them are plain joins of stored tables, which adaptive execution can split at a hub; so
    is each round, and a lost executor costs no more than a part of the current one.
    """
    pair = F.array_sort(F.array(F.col(u), F.col(v)))
    edges = (
        links.where(F.col(u) != F.col(v))
        .select(pair[1].alias("hi"), pair[0].alias("lo"))
        .distinct()
    )
    edges, before = settle(edges, label), None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if state == before:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                edges.select("lo", "lo").distinct()
            )
        before = state
        edges = settle(_small_star(settle(_large_star(edges, label), label), label), label)


def _large_star(edges: DataFrame, label: str) -> DataFrame:
    both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("near")).union(edges.select("lo", "hi"))
    least = settle(both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least")), label)
    return both.where("near > node").join(least, "node").select(F.col("near").alias("hi"), F.col("least").alias("lo"))


def _small_star(edges: DataFrame, label: str) -> DataFrame:
    least = settle(edges.groupBy("hi").agg(F.min("lo").alias("least")), label)
    moved = edges.join(least, "hi").where("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.union(least.select("hi", F.col("least").alias("lo"))).distinct()
