"""Connected components of an edge table, by alternating star contraction.

Large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014): each is one aggregation and one equi-join on the
node.  A hub keeps one row per neighbour, aggregation combines map-side, and
AQE splits a hub's rows in the joins.  Every step is checkpointed, which cuts
the lineage and survives a lost executor.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.plans.tables import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, src: str, dst: str, max_rounds: int = 60) -> DataFrame:
    """Rows (node, root) for every node of an edge; root is the smallest node
    reachable.  Null ends and loops count as no edge; repeats are harmless.
    No edges give no rows.  Any orderable node type but a map will do.
    """
    e = (edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
         .where("u is not null and v is not null and u != v").distinct())
    e = stored(e)
    before = None
    for _ in range(max_rounds):
        e = stored(_small_star(_large_star(e)).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def block_components(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of the rows and columns of a bipartite link matrix: equal where
    connected within the matrix; a row or column without links keeps its own."""
    n, m = link.shape
    row = np.arange(n, dtype=np.int32)
    col = np.arange(n, n + m, dtype=np.int32)
    none = np.int32(n + m)
    while True:
        new = np.minimum(row, np.where(link, col[None, :], none).min(axis=1, initial=none))
        newer = np.minimum(col, np.where(link, new[:, None], none).min(axis=0, initial=none))
        if np.array_equal(new, row) and np.array_equal(newer, col):
            return row, col
        row, col = new, newer


def star_edges(link: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, centre) that connect what ``link`` connects, one a node at
    most; ``rows`` and ``cols`` number the nodes."""
    a, b = block_components(link)
    names = np.concatenate([rows, cols])
    linked = np.concatenate([link.any(axis=1), link.any(axis=0)])
    centre = names[np.concatenate([a, b])]
    keep = linked & (names != centre)
    return names[keep], centre[keep]
