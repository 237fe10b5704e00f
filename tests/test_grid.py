"""Products by blocks of the output: any indices and values, no pair or partial sum shuffled."""

import random

import numpy as np
import pytest

from trellis.operators import grid as G
from trellis.operators import matrix as M

CELL = "i bigint, j bigint, v double"


def odd_cells(seed, n, rows, ks, nulls):
    r = random.Random(seed)

    def index(most):
        return None if r.random() < nulls else r.randint(-most, most)

    return [(index(rows), index(ks), None if r.random() < nulls else float(r.randint(0, 9))) for _ in range(n)]


CASES = {
    "dense": (odd_cells(1, 300, 10, 5, 0.1), [(k, i, v) for i, k, v in odd_cells(2, 300, 10, 5, 0.1)]),
    "sparse": (odd_cells(3, 300, 1000, 200, 0.05), [(k, i, v) for i, k, v in odd_cells(4, 300, 2000, 200, 0.05)]),
    "only nulls meet": ([(None, 0, 1.0), (3, 0, None)], [(0, None, 2.0), (0, 1, 5.0)]),
    "a strip heavier than the others": ([(i, i % 7, 1.0) for i in range(200)] + [(10 ** 9, 0, 2.0)],
                                        [(i % 7, j * 3, 2.0) for i in range(200) for j in (i, i + 5000)]),
    "infinite": ([(i, 0, float("inf") if i == 3 else 1.0) for i in range(50)], [(0, j, 2.0 + j) for j in range(50)]),
    "too far apart": ([(-2 ** 62, 0, 1.0), (2 ** 61, 0, 2.0)], [(0, 5, 3.0)]),
}


@pytest.mark.parametrize("case", CASES)
def test_blocks_give_the_cells_of_the_plain_join(spark, case, monkeypatch):
    monkeypatch.setattr(G, "ROW_ARRAY", 8)
    a, b = (spark.createDataFrame(x, CELL) for x in CASES[case])

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    want = rows(M.joined_product(a, b))
    assert rows(M.matmul_cells(a, b)) == want and rows(M.matmul_cells_spread(a, b)) == want
    numbered = [r for r in want if r[0] is not None and r[1] is not None]
    assert rows(M.matmul_blocked(a, b)) == numbered and rows(M.matmul_blocked(a, b, 4, 5, 3)) == numbered


@pytest.mark.parametrize("product", [M.matmul_cells, M.matmul_cells_spread, M.matmul_blocked])
def test_finished_cells_are_not_shuffled(spark, product):
    m = spark.createDataFrame([(i, k, 1.0) for i in range(30) for k in range(4)], CELL)
    plan = product(m, M.transpose(m))._jdf.queryExecution().optimizedPlan().toString()
    after = plan.split("MapIn")[0]
    assert "MapInArrow" in plan and "Aggregate" not in after and "Repartition" not in after


def test_sums_of_a_block_in_either_form():
    r = random.Random(1)
    for rows, width in ((40, 50), (10 ** 6, 10 ** 6)):
        sums, want = G.Sums(rows, width), {}
        for _ in range(20):
            at = np.array([r.choice([r.randrange(2000), r.randrange(rows * width)]) for _ in range(300)])
            value = np.array([float(r.randint(1, 9)) for _ in at])
            sums.add(at, value, np.full(len(at), 2, np.uint8))
            sums.flush()
            for p, v in zip(at.tolist(), value.tolist(), strict=True):
                want[p] = want.get(p, 0) + v
        assert sums.dense == (rows == 40)
        assert {p: v for at, value, _ in sums.parts() for p, v in zip(at.tolist(), value.tolist(), strict=True)} == want


def test_integers_are_added_as_integers(spark):
    a = spark.createDataFrame([(0, 0, 2 ** 60), (0, 1, 1)], "i bigint, j bigint, v bigint")
    b = spark.createDataFrame([(0, 0, 1), (1, 0, 1)], "i bigint, j bigint, v bigint")
    assert [tuple(r) for r in M.matmul_cells(a, b).collect()] == [(0, 0, 2 ** 60 + 1)]
    assert [tuple(r) for r in M.matmul_cells_spread(a, b).collect()] == [(0, 0, 2 ** 60 + 1)]
