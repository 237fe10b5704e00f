"""Matrix operators over cell, row and block forms.

* cell form ``(i, j, v)`` - sparse; absent cells read as 0.0;
* row form ``(i, row array<double>)`` - dense rows;
* block form ``(bi, bj, r, c, v)`` - parallel arrays of in-block positions
  and values; bounded groups of at most ``rows_per_block * cols_per_block``
  cells.

Products: ``matmul_cells`` and ``matmul_blocked`` (both sides large, added up block by
block of the output: ``trellis.operators.tiles``) and ``matmul_broadcast`` (small right side shipped
whole, local GEMM per slice of rows).  All return the same cells:
those with at least one matching k.  ``trellis.plans.matmul`` chooses among
them from sizes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.functions.blocks import row_chunk
from trellis.operators.tiles import Tiles
from trellis.plans.tables import stored

# Doubles that a task holds of a product or of dense rows at a time (32 MB).
SLICE_CELLS = 4_000_000


class ShapeError(ValueError):
    """Operand shapes do not fit the operation."""


def _div(x, n: int) -> Column:
    """Integer division in 64-bit integers (exact, unlike floor of a double)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.call_function("div", x.cast("bigint"), F.lit(int(n)).cast("bigint"))


# ---------------------------------------------------------------- conversions

def matrix_from_flat(df: DataFrame, array_col: str, ncols: int, keys: tuple = ()) -> DataFrame:
    """M1: row-major array to cells, ``i = pos div ncols``, ``j = pos % ncols``."""
    if ncols <= 0:
        raise ShapeError("ncols must be positive")
    exploded = df.select(*keys, F.posexplode(array_col).alias("pos", "v"))
    pos = F.col("pos").cast("bigint")
    return exploded.select(*keys, _div(pos, ncols).alias("i"),
                           (pos % F.lit(ncols)).alias("j"), F.col("v").cast("double").alias("v"))


def _row_lists(m: DataFrame) -> DataFrame:
    """``(i, js, vs)``: the stored cells of each row, at most the matrix width."""
    cells = m.groupBy("i").agg(F.collect_list(F.struct("j", F.col("v").cast("double").alias("v"))).alias("c"))
    return cells.select("i", F.col("c.j").alias("js"), F.col("c.v").alias("vs"))


def _row_slices(batches, width: int):
    """Arrow batches of ``_row_lists`` in slices of at most SLICE_CELLS dense
    cells: row numbers, and for every stored cell its row in the slice, its
    column and its value."""
    step = max(1, SLICE_CELLS // max(1, width))
    for batch in batches:
        for a in range(0, batch.num_rows, step):
            part = batch.slice(a, step)
            js, vs = part.column(1), part.column(2)
            n = js.value_lengths().to_numpy(zero_copy_only=False)
            yield (part.column(0).to_numpy(), np.repeat(np.arange(len(n)), n),
                   js.flatten().to_numpy(zero_copy_only=False), vs.flatten().to_numpy(zero_copy_only=False))


def matrix_to_rows(m: DataFrame, ncols: int) -> DataFrame:
    """M2: one dense array per row (absent cells 0.0) with its flat offset ``i * ncols``.

    A row group holds at most ``ncols`` cells; they are scattered into the
    dense row in time linear in its width, a slice of rows at a time.
    """
    def run(batches):
        for i, r, j, v in _row_slices(batches, ncols):
            dense = np.zeros((len(i), ncols))
            dense[r, j] = v
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, dense.size + 1, ncols, dtype=np.int32)),
                                            pa.array(dense.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(i * ncols), flat], ["i", "row_offset", "row"])

    return (_row_lists(m).select(F.col("i").cast("bigint").alias("i"), "js", "vs")
            .mapInArrow(run, "i bigint, row_offset bigint, row array<double>"))


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def matrix_shape(m: DataFrame, nrows: int | None = None, ncols: int | None = None) -> DataFrame:
    """M3: ``(nrows, ncols)`` from the largest stored indices; a declared
    dimension wins (trailing empty rows or columns store no cells)."""
    r = F.lit(nrows).cast("bigint") if nrows is not None else F.max("i") + 1
    c = F.lit(ncols).cast("bigint") if ncols is not None else F.max("j") + 1
    return m.agg(r.alias("nrows"), c.alias("ncols"))


def shape_of(m: DataFrame) -> tuple:
    """Scalar shape on the driver (one aggregate row)."""
    r = matrix_shape(m).first()
    return int(r["nrows"] or 0), int(r["ncols"] or 0)


# ---------------------------------------------------------------- bulk access

def matrix_get(m: DataFrame, wanted: DataFrame) -> DataFrame:
    """M4: values at the wanted ``(i, j)``; absent cells read 0.0."""
    return (wanted.select("i", "j").join(m.select("i", "j", "v"), ["i", "j"], "left")
            .select("i", "j", F.coalesce("v", F.lit(0.0)).alias("v")))


def matrix_set(m: DataFrame, updates: DataFrame) -> DataFrame:
    """M5: overwrite cells; ``updates`` holds one row per ``(i, j)``."""
    kept = m.join(updates.select("i", "j"), ["i", "j"], "left_anti")
    return kept.select("i", "j", "v").unionByName(updates.select("i", "j", F.col("v").cast("double")))


def matrix_incr(m: DataFrame, deltas: DataFrame) -> DataFrame:
    """M6: add to cells; repeated deltas accumulate."""
    both = m.select("i", "j", "v").unionByName(deltas.select("i", "j", F.col("v").cast("double")))
    return both.groupBy("i", "j").agg(F.sum("v").alias("v"))


def densify(m: DataFrame, nrows: int, ncols: int) -> DataFrame:
    """M7: every ``(i, j)`` of an ``nrows x ncols`` matrix, absent cells 0.0.

    The grid is generated in tasks from ``spark.range`` (no cross join) and
    joined to the stored cells on both indices.
    """
    spark = m.sparkSession
    grid = spark.range(nrows * ncols).select(
        F.expr(f"id div {int(ncols)}").alias("i"), (F.col("id") % F.lit(ncols)).alias("j"))
    return (grid.join(m.select("i", "j", "v"), ["i", "j"], "left")
            .select("i", "j", F.coalesce("v", F.lit(0.0)).alias("v")))


def matrix_diff(a: DataFrame, b: DataFrame, tol: float = 0.0) -> DataFrame:
    """Cells that differ (beyond ``tol``) or are stored on one side only."""
    j = (a.select("i", "j", F.col("v").alias("va"))
         .join(b.select("i", "j", F.col("v").alias("vb")), ["i", "j"], "full_outer"))
    if tol <= 0:
        differs = ~F.col("va").eqNullSafe(F.col("vb"))
    else:
        differs = (F.col("va").isNull() | F.col("vb").isNull()
                   | (F.abs(F.col("va") - F.col("vb")) > F.lit(tol)))
    return j.where(differs).select("i", "j", "va", "vb")


# ---------------------------------------------------------------- products

def joined_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """The product as a join on k and a partial + final aggregate, for any type of value
    and index: every pair of cells is a row of its own."""
    left = a.select("i", F.col("j").alias("k"), F.col("v").alias("va"))
    right = b.select(F.col("i").alias("k"), "j", F.col("v").alias("vb"))
    return (left.join(right, "k")
            .groupBy("i", "j").agg(F.sum(F.col("va") * F.col("vb")).alias("v")))


def matmul_cells(a: DataFrame, b: DataFrame, tiles: Tiles | None = None) -> DataFrame:
    """M8: ``c[i,j] = sum_k a[i,k] * b[k,j]``; only cells with a match are stored.

    Doubles are added up block by block (``Tiles``, given where they are packed already);
    other values by ``joined_product``.
    """
    tiles = tiles or Tiles.of(a, b)
    return tiles.product() if tiles else joined_product(a, b)


def k_blocks(a: DataFrame, b: DataFrame, tasks: int) -> DataFrame:
    """``(k, ra, rb)`` of every k whose pairs are more than a fair share of a task: the row
    blocks that its left cells and the column blocks that its right cells are cut
    into, so that one block pair is about such a share.  At most ``tasks`` rows, since
    so many such k are all pairs there are."""
    left = a.groupBy(F.col("j").alias("k")).agg(F.count(F.lit(1)).alias("na"))
    right = b.groupBy(F.col("i").alias("k")).agg(F.count(F.lit(1)).alias("nb"))
    pairs = stored(left.join(right, "k").withColumn("pairs", F.col("na").cast("double") * F.col("nb")))
    total = pairs.agg(F.sum("pairs")).first()[0] or 0.0
    share = total / tasks
    times = F.ceil(F.col("pairs") / F.lit(share or 1.0))
    rows = F.greatest(F.lit(1), F.least(F.col("na"), F.ceil(F.sqrt(times * F.col("na") / F.col("nb")))))
    return (pairs.where(F.col("pairs") > share)
            .select("k", rows.cast("int").alias("ra"),
                    F.greatest(F.lit(1), F.least(F.col("nb"), F.ceil(times / rows))).cast("int").alias("rb")))


def spread_pairs(a: DataFrame, b: DataFrame, tasks: int | None = None) -> DataFrame:
    """``(i, j, va, vb)`` of all matching cells, joined in the grid of ``matmul_cells_spread``."""
    n = tasks or int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(stored(k_blocks(a, b, 8 * n)))    # at most 8 n rows; several keys a task even out
    left = a.select("i", F.col("j").alias("k"), F.col("v").alias("va")).join(hot, "k", "left")
    right = b.select(F.col("i").alias("k"), "j", F.col("v").alias("vb")).join(hot, "k", "left")
    one = F.lit(1)

    def block(of, count):
        return F.pmod(F.xxhash64(of), F.coalesce(count, one)).cast("int")

    def copies(count):
        return F.explode(F.sequence(F.lit(0), F.coalesce(count, one) - 1))

    left = left.select("i", "k", "va", block("i", F.col("ra")).alias("x"), copies(F.col("rb")).alias("y"))
    right = right.select("j", "k", "vb", block("j", F.col("rb")).alias("y"), copies(F.col("ra")).alias("x"))
    return left.join(right, ["k", "x", "y"]).select("i", "j", "va", "vb")


def matmul_cells_spread(a: DataFrame, b: DataFrame, tasks: int | None = None) -> DataFrame:
    """M8 where a k may hold a large share of both sides.

    A hot k's pairs are the product of its two sides, while a split by rows of one
    side at a time (AQE) copies the whole other side to every part.  Doubles are cut
    in strips of rows and of columns (``Tiles``), whose pairs are made and added up where
    two strips meet, so that no pair is a row.  Other values: a hot k becomes a grid of ``ra x rb`` keys
    (``spread_pairs``); every pair meets in one key and no key holds more than about
    a task's fair share.  The cells are those of ``matmul_cells``.
    """
    tiles = Tiles.of(a, b)
    if tiles:
        return tiles.product(tasks)
    return (spread_pairs(a, b, tasks).groupBy("i", "j").agg(F.sum(F.col("va") * F.col("vb")).alias("v")))


def check_inner(shape_a: tuple, shape_b: tuple) -> None:
    if shape_a[1] != shape_b[0]:
        raise ShapeError(f"cannot multiply {shape_a[0]}x{shape_a[1]} by {shape_b[0]}x{shape_b[1]}")


def matmul_dense(a: DataFrame, b: DataFrame, shape_a: tuple, shape_b: tuple) -> DataFrame:
    """M9: the product with every output cell present, 0.0 where nothing matched."""
    check_inner(shape_a, shape_b)
    return densify(matmul_cells(a, b), shape_a[0], shape_b[1])


def row_blocks(spark: SparkSession, nrows: int, ncols: int, size: int) -> DataFrame:
    """``size`` contiguous row blocks of ``ceil(nrows/size)`` rows, last clamped.

    More blocks than rows give empty blocks (``n_rows = 0``), never negative.
    """
    chunk = row_chunk(nrows, size)
    b = F.col("id")
    start = b * F.lit(chunk)
    end = F.least((b + 1) * F.lit(chunk), F.lit(nrows))
    n_rows = F.greatest(F.lit(0), end - start)
    return spark.range(size).select(
        b.alias("block"), start.alias("start_row"), n_rows.alias("n_rows"),
        (start * F.lit(ncols)).alias("elem_offset"), (n_rows * F.lit(ncols)).alias("n_elems"))


def matmul_broadcast(a: DataFrame, b: DataFrame, shape_b: tuple, max_cells: int = SLICE_CELLS) -> DataFrame:
    """Rows of ``a`` times a small ``b`` that every task holds whole.

    ``b`` is shipped only where its dense shape has at most ``max_cells``
    cells (a proven bound); a larger one goes through ``matmul_blocked``,
    which returns the same cells.  The rows of ``a`` are grouped by the
    shuffle, so the number of tasks follows the data; a task multiplies a
    slice of rows of bounded size at a time.  As in ``matmul_cells`` only
    cells with a matching k are returned.

    The rows are dealt to a fixed number of tasks: a scan of one row group is one
    task, and AQE, which sees only few bytes, would join the shuffle's parts to one
    again, though the product of a row costs far more than its bytes.
    """
    nrows_b, ncols_b = shape_b
    if nrows_b * ncols_b > max_cells:
        return matmul_blocked(a, b)
    cells = b.select("i", "j", F.col("v").cast("double").alias("v")).toArrow()
    value = np.zeros((nrows_b, ncols_b))
    held = np.zeros((nrows_b, ncols_b), np.float32)
    at = (cells["i"].to_numpy(), cells["j"].to_numpy())
    np.add.at(value, at, cells["v"].to_numpy())
    held[at] = 1
    shared = a.sparkSession.sparkContext.broadcast((value, held))

    def run(batches):
        bv, bh = shared.value
        for i, r, j, v in _row_slices(batches, max(bv.shape)):
            av, ah = np.zeros((len(i), len(bv))), np.zeros((len(i), len(bv)), np.float32)
            np.add.at(av, (r, j), v)
            ah[r, j] = 1
            rr, cc = np.nonzero(ah @ bh)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i[rr]), pa.array(cc.astype(np.int64)), pa.array((av @ bv)[rr, cc])], ["i", "j", "v"])

    n = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (_row_lists(a.repartition(n, "i")).select(F.col("i").cast("bigint").alias("i"), "js", "vs")
            .mapInArrow(run, "i bigint, j bigint, v double"))


def to_blocks(m: DataFrame, rows_per_block: int, cols_per_block: int) -> DataFrame:
    """Cells grouped into blocks ``(bi, bj, r, c, v)`` with ``r``, ``c``, ``v``
    parallel arrays of in-block positions and values; each group holds at
    most ``rows_per_block * cols_per_block`` cells."""
    cell = F.struct((F.col("i") % rows_per_block).alias("r"), (F.col("j") % cols_per_block).alias("c"),
                    F.col("v").cast("double").alias("v"))
    grouped = (m.select(_div("i", rows_per_block).alias("bi"), _div("j", cols_per_block).alias("bj"), cell.alias("cell"))
               .groupBy("bi", "bj").agg(F.collect_list("cell").alias("cells")))
    return grouped.select("bi", "bj", F.col("cells.r").alias("r"), F.col("cells.c").alias("c"),
                          F.col("cells.v").alias("v"))


def matmul_blocked(a: DataFrame, b: DataFrame, rows_per_block: int | None = None,
                   k_per_block: int = 4096, cols_per_block: int | None = None,
                   num_partitions: int | None = None, tiles: Tiles | None = None) -> DataFrame:
    """Product for operands that do not fit in memory.

    The output is cut in blocks of ``rows_per_block x cols_per_block`` cells (by default sized
    from the data, ``Tiles``); a block is added up in one task from the parts of the
    operands that meet in it, at most ``k_per_block`` k at a time where they are
    dense enough for numpy's matrix product.  The result stores exactly the cells that
    ``matmul_cells`` stores, of rows and columns that have a number.

    Memory per task is bounded by the block: SLICE_CELLS sums and marks.
    """
    tiles = tiles or Tiles.of(a, b)
    if tiles:
        return tiles.product(num_partitions, rows_per_block, cols_per_block, k_per_block, numbered=True)
    return joined_product(a.where(F.col("i").isNotNull()), b.where(F.col("j").isNotNull()))


def gather_blocks(m: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Cells placed in row order (range-partitioned on (i, j), sorted
    within), so a heavy row is spread over several tasks."""
    n = num_partitions or int(m.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return m.repartitionByRange(n, "i", "j").sortWithinPartitions("i", "j")
