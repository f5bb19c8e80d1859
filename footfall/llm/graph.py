"""Connected components of a distributed edge list."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.session import materialise


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one edge per vertex, to the smallest vertex of its component; self-loops vanish."""
    vertices, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(vertices))
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = label[label]
        if np.array_equal(label, before) and np.array_equal(label[x], label[y]):
            break
    off = np.flatnonzero(label != np.arange(len(vertices)))
    return vertices[off], vertices[label[off]]


def components(edges: DataFrame) -> DataFrame:
    """``fp, root`` for each vertex of edges ``a, b``; the root is the smallest vertex.

    Large-star and small-star steps alternate until every vertex hangs on its root. Each round is
    written to the shared folder, so lineage stays short; a hub's rows meet in joins that Spark can
    split and in minima that are combined before the shuffle.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        """``u, v`` with v the neighbour; point the larger (or all smaller) neighbours at the minimum."""
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = pairs.join(least, "u")
        if large:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.where("m < u").select("u", F.col("m").alias("v"))
        return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)

    current = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    seen = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        grown = star(both, large=True).where("u <> v").distinct()
        down = grown.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        current = materialise(star(down, large=False).where("u <> v").distinct(), "stars")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return current.groupBy(F.col("u").alias("fp")).agg(F.min("v").alias("root"))
        seen = state
