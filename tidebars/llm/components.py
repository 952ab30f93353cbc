"""Connected components by alternating star contractions; nothing is gathered."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import dealt_join
from tidebars.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges`` (``a, b``, long): the least node reachable.

    Every round links each node's larger neighbours to its least neighbour, then its smaller ones; both are
    aggregates and joins on the node, in which hubs are pre-aggregated or split. Rounds grow with the logarithm
    of the longest path. Self loops and repeated edges change nothing; no edges give no rows.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    star = stage(edges.where("a <> b").select(high, low).distinct())
    last = None
    while True:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = dealt_join(both, least, ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = dealt_join(large, least, ["a"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = stage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        state = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            roots = star.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return star.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        last = tuple(state)


def stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of each of ``n`` places the least place reachable over the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
