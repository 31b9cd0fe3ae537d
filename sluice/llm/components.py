"""Connected components of an edge list by alternating star contraction, on DataFrames.

Every round hooks each node's neighbours to the smallest node it sees; rounds are cut with written tables.
Aggregations are partial before each shuffle, so a node with very many links is no hot spot. Few links need no rounds of
jobs: up to ``FEW`` of them (4 MB) are grouped by the driver, with the same result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.common import release, stage


FEW = 1 << 18


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of the links (u, v), and for each the smallest node reachable."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node in ``edges`` (a, b); root is the smallest node reachable."""
    e = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    if e.count() <= FEW:
        links = e.toArrow()
        node, root = smallest_reachable(links.column("u").to_numpy(), links.column("v").to_numpy())
        release(e)
        return edges.sparkSession.createDataFrame(pa.table({"node": pa.array(node, pa.int64()), "root": pa.array(root, pa.int64())}))
    while True:
        first = e
        before = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        # large star: every larger neighbour hooks to the smallest one seen
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        half = stage(both.filter("v > u").join(low, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .distinct(), "edges")
        # small star: smaller neighbours and the node itself hook to the smallest
        e = half
        low = e.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        joined = e.join(low, F.col("u") == F.col("x"))
        e = stage(joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .union(low.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        release(first, half)
        after = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == after:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v")).distinct()
