"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node that an edge (a, b) touches; component is its smallest node.

    Each round hangs every neighbour larger than a node on the node's smallest neighbour (large
    star), then every smaller neighbour on the smallest one (small star). Edges never multiply,
    sums are taken before the shuffle and joins are plain equi-joins, so that a hub with very many
    neighbours is split by Spark. Ends when a round changes nothing.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def stars(n: int, edges: list[tuple[np.ndarray, np.ndarray]], names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node's smallest name within reach over the edges, for nodes that are not it themselves."""
    low = names.copy()
    while True:
        was = low.copy()
        for i, j in edges:
            np.minimum.at(low, i, was[j])
            np.minimum.at(low, j, low[i])
        if (low == was).all():
            keep = low != names
            return names[keep], low[keep]
