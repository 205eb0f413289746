"""Connected components of a table of links, by alternating large and small stars.

Each round is two joins and four aggregates on the links, all with partial sums before the
shuffle; the join on a hub's key is a plain sort-merge join, which adaptive execution splits.
Rounds grow with the logarithm of the longest chain. Nothing is collected but a row's checksum.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.shared import store


def _checksum(links: DataFrame):
    return links.agg(
        F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
    ).first()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Links to itself, repeated links and links given both ways change nothing; links with a
    null end are ignored; no links give no rows.
    """
    ends = links.where(F.col(a) != F.col(b))
    star = store(
        ends.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    before = _checksum(star)
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        star = store(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "star")
        after = _checksum(star)
        if after == before:
            break
        before = after
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) that connect what these links connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]
