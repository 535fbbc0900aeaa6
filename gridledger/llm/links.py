"""Connected components of a link table, as rounds of Spark joins."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.session import Workspace


def components(links: DataFrame, space: Workspace, name: str) -> DataFrame:
    """Smallest node reachable from each linked node: columns ``node``, ``root``.

    ``links`` has two long columns ``a`` and ``b``; order, repeats and loops don't
    matter, rows with a null are no links. Nodes that are their own root have no row.

    Star contraction: a round first hangs the larger neighbours of every node on the
    node's smallest neighbour, then the node and its smaller neighbours. Minima are
    partial aggregates, written before they are joined, so a node with very many
    neighbours is a skewed join that Spark splits at run time. Each round is a written
    table, so a lost executor costs one round at most.
    """
    edges = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = space.stage(edges, f"{name}-0")
    seen = None
    for i in itertools.count(1):
        size = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if size == seen or not size[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = size
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        low = space.stage(low, f"{name}-{i}-low")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = space.stage(large.where("a <> b").distinct(), f"{name}-{i}-large")
        low = space.stage(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-{i}-least")
        met = large.join(low, "a")
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))
        )
        edges = space.stage(small.where("a <> b").distinct(), f"{name}-{i}")


class Forest:
    """Groups of rows inside one task, so that it emits a tree of links, not all pairs."""

    def __init__(self, size: int):
        self.low = np.arange(size)

    def grow(self, size: int) -> None:
        self.low = np.concatenate([self.low, np.arange(len(self.low), size)])

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Merge the groups of all pairs ``a[i]``, ``b[i]``; the smallest row leads."""
        while len(a):
            x, y = self.low[a], self.low[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.low, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.low[self.low]
                if np.array_equal(up, self.low):
                    break
                self.low = up

    def tree(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows that don't lead their group, and the rows that lead them."""
        member = np.flatnonzero(self.low != np.arange(len(self.low)))
        return member, self.low[member]
