"""Connected components of a large set of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.sources.staging import staged


def components(links: DataFrame) -> DataFrame:
    """``node`` and the ``root`` of its component, for every node in ``links`` (columns ``a`` and ``b``).

    In each round a node is merged into the neighbour, itself included, that comes first in a random order,
    and links inside a merged node vanish. The order is drawn anew for each round, so that long
    chains shrink by a constant share as well. Links stay distributed, hubs are combined before the shuffle, and every
    round is written out.
    """
    live = staged(_between(links, "a", "b"), "links")
    roots, turn = None, 0
    while not live.isEmpty():
        turn += 1
        both = live.select("a", "b").unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        closed = both.unionByName(live.select("a", F.col("a").alias("b"))).unionByName(
            live.select(F.col("b").alias("a"), "b")
        )
        first = F.min(F.struct(F.xxhash64("b", F.lit(turn)), F.col("b"))).alias("first")
        hooks = staged(closed.groupBy("a").agg(first).select(F.col("a").alias("node"), F.col("first.b").alias("root")), "hooks")
        if roots is None:
            roots = hooks
        else:
            later = hooks.select(F.col("node").alias("root"), F.col("root").alias("_later"))
            roots = staged(
                roots.join(later, "root", "left").select("node", F.coalesce("_later", "root").alias("root")), "roots"
            )
        start = hooks.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        end = hooks.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        live = staged(_between(live.join(start, "a").join(end, "b"), "_a", "_b"), "links")
    return live.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots


def _between(links: DataFrame, a: str, b: str) -> DataFrame:
    return links.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


class Forest:
    """Links of one task, kept only if they join two trees."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            x, y = self.root(a), self.root(b)
            if x != y:
                self.parent[y] = x
                self.links.append((a, b))
        while (self.parent != (up := self.parent[self.parent])).any():
            self.parent = up
