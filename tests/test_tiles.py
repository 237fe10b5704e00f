"""Products of operands that are stored once: nothing of them is copied by a shuffle."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.test_grid import CASES, CELL, odd_cells
from trellis.operators import matrix as M
from trellis.operators import tiles as T
from trellis.plans.matmul import matmul, sizes


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


HEAVY = ([(7, k, 1.0 + k % 3) for k in range(90)] + [(None, k, 2.0) for k in range(70)] + [(i, i % 90, 1.0) for i in range(40)],
         [(k, j, 1.0) for j, n in ((5, 80), (None, 60), (6, 3)) for k in range(n)] + [(k, 100 + k, None) for k in range(30)])


@pytest.mark.parametrize("case", [*CASES, "rows of more cells than a strip"])
def test_strips_give_the_cells_of_the_plain_join(spark, case, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 50)
    monkeypatch.setattr(T, "BUCKETS", 8)
    a, b = (spark.createDataFrame(x, CELL) for x in CASES.get(case, HEAVY))
    want = rows(M.joined_product(a, b))
    numbered = [r for r in want if r[0] is not None and r[1] is not None]
    assert rows(T.Tiles.of(a, b).product(3)) == want
    assert rows(T.Tiles.of(a, b).product(3, 4, 5, 3, numbered=True)) == numbered


def block(cells):
    """A strip of (row, k, value) as it is stored."""
    t = pa.table(list(zip(*cells, strict=True)), schema=pa.schema([("r", pa.int64()), ("k", pa.int64()), ("v", pa.float64())]))
    packs = [x for b in T._pack(50, 4)(t.to_batches()) for x in b.column("cells").to_pylist() if x is not None]
    held = pa.RecordBatch.from_arrays([pa.array([0] * len(packs)), pa.array([0] * len(packs)), pa.array(packs)], ["strip", "part", "cells"])
    return T._Block(next(T._gather({}, False)([held])).column("cells")[0].as_buffer())


@pytest.mark.parametrize("cells, pairs", [(10 ** 6, 10 ** 6), (200, 30), (64, 10 ** 4)])
@pytest.mark.parametrize("size", [(None, None), (3, None), (None, 4), (5, 7)])
@pytest.mark.parametrize("nulls, ks", [(0, 3), (0, 60), (0.1, 3), (0.1, 1000)])
def test_a_pair_of_strips_in_any_blocks(monkeypatch, cells, pairs, size, nulls, ks):
    monkeypatch.setattr(T, "CELLS", cells)
    monkeypatch.setattr(T, "PAIRS", pairs)
    sides = [[(r, k, v) for r, k, v in odd_cells(s, 250, 12, ks, nulls) if k is not None] for s in (5, 6)]
    left, right = map(block, sides)
    got = {}
    for r, c, v, mark in T._products(left, right, *size, 2):
        for cell in zip(left.numbers(r).to_pylist(), right.numbers(c).to_pylist(), np.where(mark < 2, np.nan, v).tolist(), strict=True):
            assert cell[:2] not in got
            got[cell[:2]] = None if np.isnan(cell[2]) else cell[2]
    want = {}
    for r, k, v in sides[0]:
        for c, x, y in sides[1]:
            if x == k:
                own = want.setdefault((r, c), [])
                own.extend([v * y] if v is not None and y is not None else [])
    assert got == {k: sum(v) if v else None for k, v in want.items()}


def test_arrays_come_back_as_they_were_written():
    far = np.array([-2 ** 63, 2 ** 63 - 1, 0, 5])
    arrays = [far, np.zeros(0, np.int64), np.arange(300) + 2 ** 40, np.array([1.5, np.nan, np.inf]), np.array([True, False])]
    for x, y in zip(arrays, T._read(T._write(*arrays)), strict=True):
        assert x.dtype == y.dtype and np.array_equal(x, y, equal_nan=x.dtype.kind == "f")


def test_words_as_k(spark):
    r = random.Random(3)
    a, b = ([(r.randrange(9), r.choice(["a", "b", "c", None]), float(r.randrange(5))) for _ in range(60)] for _ in range(2))
    a = spark.createDataFrame(a, "i bigint, j string, v double")
    b = M.transpose(spark.createDataFrame(b, "i bigint, j string, v double"))
    for y in (b, M.transpose(a)):
        assert rows(M.matmul_cells(a, y)) == rows(M.joined_product(a, y))


def not_copied(product):
    """The product's plan brings no cells to the blocks they meet in."""
    plan = product._jdf.queryExecution().executedPlan().toString()
    return "CartesianProduct" in plan and "Exchange" not in plan


def test_hot_k_product_copies_no_side(spark):
    m = spark.createDataFrame([(i, k, 1.0) for i in range(60) for k in range(7)], CELL)
    product = M.matmul_cells_spread(m, M.transpose(m))
    assert not_copied(product) and product.count() == 3600 and product.where("v != 7").count() == 0


def test_blocked_product_copies_no_side(spark):
    m = spark.createDataFrame([(i, (i * 7 + k) % 90, 1.0 + k) for i in range(80) for k in range(5)] + [(None, 3, 1.0)], CELL)
    product = M.matmul_blocked(m, M.transpose(m))
    assert not_copied(product)
    assert rows(product) == [r for r in rows(M.joined_product(m, M.transpose(m))) if r[0] is not None and r[1] is not None]


def counted(spark, cells):
    """The cells, and how many of them have been computed so far."""
    n = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            n.add(batch.num_rows)
            yield batch
    return spark.createDataFrame(cells, CELL).mapInArrow(run, CELL), n


def test_a_side_and_its_transpose_are_read_once(spark):
    cells = [(i, (i * 5 + k) % 70, 1.0 + k) for i in range(60) for k in range(4)]
    m, n = counted(spark, cells)
    product = M.matmul_cells(m, M.transpose(m))
    assert not_copied(product)
    plain = spark.createDataFrame(cells, CELL)
    assert rows(product) == rows(M.joined_product(plain, M.transpose(plain))) and n.value == len(cells)


@pytest.mark.parametrize("cells", [[(i, (i * 5 + k) % 70, 1.0 + k) for i in range(60) for k in range(4)], [(0, 900, 2.0), (None, 3, 1.0)],
                                   [(i, k, 1.0) for i in range(20) for k in range(30)]])
def test_chosen_strategy_takes_sizes_and_product_from_one_pass(spark, cells):
    m, n = counted(spark, cells)
    got = rows(matmul(m, M.transpose(m), strategy="auto" if cells[0] != (0, 0, 1.0) else "blocked"))
    plain = spark.createDataFrame(cells, CELL)
    assert got == rows(M.joined_product(plain, M.transpose(plain))) and n.value == len(cells)
    assert packed_sizes(m) == sizes(m)


def packed_sizes(m):
    return T.Tiles.of(m, M.transpose(m)).sizes()
