"""Matrices: tiny hand cases, shape errors and cross-strategy equality."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trellis.operators import matrix as M
from trellis.operators import synth
from trellis.plans.matmul import matmul


def cells(spark, arr):
    rows = [(i, j, float(v)) for (i, j), v in np.ndenumerate(arr) if v != 0]
    return spark.createDataFrame(rows, "i bigint, j bigint, v double")


def to_dense(df, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r["i"], r["j"]] += r["v"]
    return out


A = np.array([[1.0, 2.0, 0.0], [0.0, 0.0, 0.0]])  # 2x3 with an all-zero row
B = np.array([[1.0, 4.0], [2.0, 0.0], [3.0, 5.0]])  # 3x2


def test_matmul_strategies_agree(spark):
    a, b = cells(spark, A), cells(spark, B)
    want = A @ B
    assert np.array_equal(to_dense(M.matmul_cells(a, b), (2, 2)), want)
    assert np.array_equal(to_dense(M.matmul_blocked(a, b, 1, 2, 1), (2, 2)), want)
    assert np.array_equal(to_dense(M.matmul_broadcast(a, b, (3, 2)), (2, 2)), want)


@pytest.mark.parametrize("strategy", ["auto", "cells", "blocked", "broadcast"])
def test_every_strategy_returns_the_same_cells(spark, strategy):
    # a zero row, a zero column, a stored zero, and a k that meets nothing
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (2, 1, 0.0), (3, 3, 5.0)], "i bigint, j bigint, v double")
    b = spark.createDataFrame([(0, 0, 1.0), (1, 0, 2.0), (1, 2, -4.0), (2, 1, 3.0)], "i bigint, j bigint, v double")
    got = sorted(tuple(r) for r in matmul(a, b, (4, 4), (4, 3), strategy=strategy).collect())
    assert got == [(0, 0, 5.0), (0, 2, -8.0), (2, 0, 0.0), (2, 2, 0.0)]


def test_wide_rows_take_linear_time(spark):
    import time
    m = spark.range(20 * 8000).select((F.col("id") % 20).alias("i"), F.expr("id div 20").alias("j"),
                                      F.col("id").cast("double").alias("v"))
    t = time.time()
    rows = M.matrix_to_rows(m, 8000).collect()
    assert time.time() - t < 20 and len(rows) == 20
    assert all(r.row[7] == 140.0 + r.i and len(r.row) == 8000 and r.row_offset == 8000 * r.i for r in rows)


def test_exact_integer_division(spark):
    big = 2 ** 60 + 3
    m = spark.createDataFrame([(big, big, 1.0)], "i bigint, j bigint, v double")
    r = M.to_blocks(m, 2, 2).first()
    assert (r.bi, r.bj, r.r[0], r.c[0]) == (big // 2, big // 2, 1, 1)


def test_sparse_vs_dense_product(spark):
    a, b = cells(spark, A), cells(spark, B)
    # the all-zero row matches nothing: absent from the sparse result ...
    assert M.matmul_cells(a, b).where("i = 1").count() == 0
    # ... and present as zeros in the dense one
    dense = M.matmul_dense(a, b, (2, 3), (3, 2))
    assert dense.count() == 4
    assert np.array_equal(to_dense(dense, (2, 2)), A @ B)


def test_blocked_keeps_exact_cell_set(spark):
    rng = np.random.default_rng(3)
    a_np = rng.integers(0, 3, (23, 17)) * (rng.random((23, 17)) < 0.3)
    b_np = rng.integers(0, 3, (17, 11)) * (rng.random((17, 11)) < 0.3)
    a, b = cells(spark, a_np), cells(spark, b_np)
    x = {(r["i"], r["j"]): r["v"] for r in M.matmul_cells(a, b).collect()}
    y = {(r["i"], r["j"]): r["v"] for r in M.matmul_blocked(a, b, 4, 5, 3).collect()}
    assert x == y


def test_shape_mismatch_raises(spark):
    a = cells(spark, A)
    b = cells(spark, np.ones((2, 2)))
    with pytest.raises(M.ShapeError):
        M.matmul_dense(a, b, (2, 3), (2, 2))
    with pytest.raises(M.ShapeError):
        matmul(a, b, (2, 3), (2, 2))


def test_row_blocks_more_blocks_than_rows(spark):
    got = [tuple(r) for r in M.row_blocks(spark, 5, 3, 4).orderBy("block").collect()]
    # chunk = 2: blocks [0,2) [2,4) [4,5) and an empty fourth, never negative
    assert got == [(0, 0, 2, 0, 6), (1, 2, 2, 6, 6), (2, 4, 1, 12, 3), (3, 6, 0, 18, 0)]
    assert M.row_blocks(spark, 5, 3, 9).where("n_rows < 0").count() == 0


def test_flat_rows_roundtrip(spark):
    df = spark.createDataFrame([(7, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])], "id bigint, values array<double>")
    c = M.matrix_from_flat(df, "values", 3, keys=("id",))
    assert sorted((r["i"], r["j"], r["v"]) for r in c.collect())[:4] == [
        (0, 0, 1.0), (0, 1, 2.0), (0, 2, 3.0), (1, 0, 4.0)]
    rows = {r["i"]: (r["row_offset"], list(r["row"])) for r in M.matrix_to_rows(c, 3).collect()}
    assert rows == {0: (0, [1.0, 2.0, 3.0]), 1: (3, [4.0, 5.0, 6.0])}
    assert tuple(M.matrix_shape(c).first()) == (2, 3)
    assert tuple(M.matrix_shape(c, nrows=5).first()) == (5, 3)


def test_get_set_incr_diff(spark):
    a = cells(spark, A)
    wanted = spark.createDataFrame([(0, 1), (1, 1), (0, 1)], "i bigint, j bigint")
    assert [r["v"] for r in M.matrix_get(a, wanted).orderBy("i").collect()] == [2.0, 2.0, 0.0]
    upd = spark.createDataFrame([(0, 0, 9.0), (1, 2, 1.0)], "i bigint, j bigint, v double")
    s = M.matrix_set(a, upd)
    assert np.array_equal(to_dense(s, (2, 3)), np.array([[9.0, 2.0, 0.0], [0.0, 0.0, 1.0]]))
    inc = spark.createDataFrame([(0, 0, 1.0), (0, 0, 1.0)], "i bigint, j bigint, v double")
    assert to_dense(M.matrix_incr(a, inc), (2, 3))[0, 0] == 3.0
    diff = {(r["i"], r["j"]) for r in M.matrix_diff(a, s).collect()}
    assert diff == {(0, 0), (1, 2)}
    assert M.matrix_diff(a, a).count() == 0


def test_densify_and_gather(spark):
    d = M.densify(cells(spark, A), 2, 3)
    assert d.count() == 6
    g = M.gather_blocks(d, 2).collect()
    assert [(r["i"], r["j"]) for r in g] == sorted((r["i"], r["j"]) for r in g)


def test_synth_matrix_is_reproducible(spark):
    m = synth.synth_matrix(spark, 30, 20)
    x = to_dense(m, (30, 20))
    assert x.min() >= 0 and x.max() <= 99 and np.array_equal(x, np.floor(x))
    assert np.array_equal(x, to_dense(synth.synth_matrix(spark, 30, 20), (30, 20)))
