"""Connected components of a graph given as a table of links, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racestream.session import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on the smallest node around."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours on the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    others = down.join(least, "a").where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame, purpose: str) -> DataFrame:
    """From links ``(a, b)`` to ``(node, component)``: each linked node and the least node it can reach.

    A hub's links are split over tasks by the aggregations and by adaptive joins; the state of each round is a written table.
    The number of rounds grows with the logarithm of the nodes. Nodes without links do not appear.
    """
    stars = written(links.select("a", "b").where("a != b").distinct(), purpose)
    before = None
    while True:
        row = stars.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == before or row[0] == 0:
            break
        before = tuple(row)
        stars = written(_small_star(written(_large_star(stars), purpose)), purpose)
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member that each of ``n`` members reaches over links, within one task."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label
