"""Connected components over an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(a long, b long); component is the smallest node that it reaches.

    Each round is two joins of the edges with the least neighbour of each node. Least neighbours are pre-aggregated, and a node
    with very many edges lies on the side of the join that Spark can split. Each round's edges are written to the shared folder.
    Edges from a node to itself give that node its own component; an empty table gives none.
    """
    loops = edges.filter("a = b").select(F.col("a").alias("node"), F.col("b").alias("component"))
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    last = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if last == mark:
            break
        last = mark
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.union(least.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        discard(now, large)
        now = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).union(loops).groupBy("node").agg(F.min("component").alias("component"))


class Forest:
    """Labels of n points under links that come in pieces; a label is the smallest point reached so far."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label[:] = jumped

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Points and their labels where these differ."""
        points = np.flatnonzero(self.label != np.arange(len(self.label)))
        return points, self.label[points]
