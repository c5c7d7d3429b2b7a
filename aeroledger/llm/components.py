"""Connected components of an edge table, by alternating large and small stars.

Each round is two aggregations and two joins over the edges; nothing is collected but a count and a checksum. Minimum neighbours are combined
within each task before the shuffle, and the joins are split by adaptive execution when a hub holds many edges.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroledger.llm.common import durable


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node of `edges` (two columns of one ordered type) that is no root.

    Loops, null ends and repeated edges are ignored; without edges the result is empty. Each round starts from a checkpoint.
    """
    a, b = (F.col(c) for c in edges.columns)
    stars = durable(edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    seen = _checksum(stars)
    while seen[0]:
        stars = durable(_small_star(_large_star(stars)))
        before, seen = seen, _checksum(stars)
        if seen == before:
            break
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _checksum(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _large_star(stars: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour, or to itself if it is the smallest."""
    both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(stars.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("lo"), F.least("u", "m").alias("m"))
    return stars.join(least, "lo").select("hi", F.col("m").alias("lo")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    least = stars.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = stars.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


class LocalComponents:
    """Components of the rows of one task's arrays, joined as links are found."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.parent[i], self.parent[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            self.roots()

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up
