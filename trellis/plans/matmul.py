"""Choosing a physical strategy for a matrix product from sizes.

* ``cells`` - a sparse left operand: pairs made and added up block by block
  of the output, blocks sized from the pairs;
* ``broadcast`` - a dense left operand and a right operand that, densified,
  holds at most ``broadcast_cells`` values: ship it whole (the reference's
  strategy) and run one GEMM per slice of rows of the left operand;
* ``blocked`` - everything else: the same, with GEMM where blocks are dense.

The strategies differ in cost only: each returns the cells with at least one
matching k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.operators import matrix as M
from trellis.operators.tiles import Tiles

STRATEGIES = ("auto", "broadcast", "cells", "blocked")


def sizes(m: DataFrame) -> tuple[int, tuple[int, int]]:
    """Stored cells and shape, from one aggregate."""
    r = m.agg(F.count(F.lit(1)).alias("nnz"), F.max("i").alias("i"), F.max("j").alias("j")).first()
    return r["nnz"], (0 if r["i"] is None else r["i"] + 1, 0 if r["j"] is None else r["j"] + 1)


def choose(shape_a: tuple, shape_b: tuple, nnz_a: int, broadcast_cells: int = M.SLICE_CELLS,
           density_cutoff: float = 0.05) -> str:
    """A sparse left side (at most ``density_cutoff`` of its cells stored)
    is multiplied by cells - densifying its rows would cost more than the product.
    A dense left side uses the broadcast GEMM when the right side is proven
    small by its shape, else the blocked product.
    """
    if nnz_a <= shape_a[0] * shape_a[1] * density_cutoff:
        return "cells"
    return "broadcast" if shape_b[0] * shape_b[1] <= broadcast_cells else "blocked"


def matmul(a: DataFrame, b: DataFrame, shape_a: tuple | None = None, shape_b: tuple | None = None,
           strategy: str = "auto", **block_sizes) -> DataFrame:
    """``a @ b`` in cell form ``(i, j, v)``: the cells with a matching k,
    whatever the strategy.  Sizes are taken from one aggregate over each side;
    a declared shape wins over the stored one.  A side times its own transpose is
    packed first, so that its sizes and the product take one pass over its lineage.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    nnz_a = tiles = None
    if shape_a is None or strategy == "auto":
        tiles = Tiles.of(a, b) if strategy != "broadcast" and Tiles.is_gram(a, b) else None
        nnz_a, stored = tiles.sizes() if tiles else sizes(a)
        shape_a = shape_a or stored
        shape_b = shape_b or (stored[::-1] if tiles else None)
    shape_b = shape_b or sizes(b)[1]
    M.check_inner(shape_a, shape_b)
    if strategy == "auto":
        strategy = choose(shape_a, shape_b, nnz_a)
    if strategy == "cells":
        return M.matmul_cells(a, b, tiles)
    if strategy == "blocked":
        return M.matmul_blocked(a, b, **block_sizes, tiles=tiles)
    return M.matmul_broadcast(a, b, shape_b)
