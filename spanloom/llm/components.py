"""Connected components of a graph given as pairs of long node numbers.

Alternating stars: the large star links every larger neighbour of a node to the smallest
neighbour, the small star every smaller one. Both keep components, and the edges end as stars
around the smallest node of each component, after a logarithmic number of rounds in practice.
Minima combine on the map side; joins are between written tables, so that a node with very many
edges is split at run time; only a count and a checksum come to the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from spanloom.staging import stage


def _with_least(edges: DataFrame, name: str) -> DataFrame:
    """(u, v, m): the edges with the smallest neighbour of u; ``edges`` is a written table."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")
    return edges.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u")).drop("_u")


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(mark % 1_000_000_007), F.bit_xor(mark)).first())


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node.

    Loops and repeated edges do no harm. No edges give no rows.
    """
    spread = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stage(spread.where("u <> v").distinct(), name)
    state = _state(edges)
    while True:
        both = stage(
            edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), name
        )
        large = (
            _with_least(both, name).where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        )
        large = stage(large.where("u <> v").distinct(), name)
        joined = _with_least(large, name)
        small = joined.select("u", F.col("m").alias("v")).unionByName(
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = stage(small.where("u <> v").distinct(), name)
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def forest(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each index of a symmetric boolean matrix."""
    size = len(linked)
    label = np.arange(size)
    while True:
        near = np.where(linked, label[None, :], size).min(axis=1, initial=size)
        better = np.minimum(label, near)
        better = better[better]
        if (better == label).all():
            return label
        label = better
