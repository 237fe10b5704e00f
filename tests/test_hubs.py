"""Hubs and hot keys: lists in parts (G2, G4), a hot k (M8), row-block files."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trellis.operators import graph as G
from trellis.operators import matrix as M
from trellis.session import shared_dir
from trellis.sources.row_blocks import block_index, read_rows, write_row_blocks

CELL = "i bigint, j bigint, v double"


def hub_links():
    """A third of the links leave site 1; site 2 links one site 500 times over."""
    r = random.Random(2)
    return ([(1, r.randint(0, 400)) for _ in range(1000)] + [(2, 7)] * 500 + [(2, r.randint(0, 30)) for _ in range(100)]
            + [(r.randint(3, 60), r.randint(0, 99)) for _ in range(1400)])


@pytest.mark.parametrize("size", [1, 7, 100, 100_000])
def test_parts_end_to_end_are_the_sorted_list(spark, size):
    links = hub_links()
    parts = G.links_to_adjacency_parts(spark.createDataFrame(links, "src bigint, dst bigint").repartition(5), size).collect()
    assert max(len(p.edges) for p in parts) <= size
    want = {}
    for a, b in links:
        want.setdefault(a, []).append(b)
    got = {}
    for p in sorted(parts, key=lambda p: (p.id, p.part)):
        own = got.setdefault(p.id, [])
        assert len(own) == p.part * size                   # parts are full but for the last, none is missing
        own += p.edges
    assert got == {a: sorted(b) for a, b in want.items()}


def test_rank_join_of_parts_equals_the_join_of_lists(spark):
    links = spark.createDataFrame(hub_links(), "src bigint, dst bigint")
    nodes = spark.range(0, 70)
    ranks = spark.range(0, 65).select("id", (F.col("id") / 10.0).alias("rank"))
    whole = G.site_rank_join(G.links_to_adjacency(nodes, links), ranks)
    parts = G.site_rank_join_parts(nodes, G.links_to_adjacency_parts(links, 50), ranks)
    joined = parts.groupBy("id", "rank").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "edges"))),
                                                                  lambda p: p["edges"])).alias("edges")).select("id", "edges", "rank")
    key = lambda r: (r.id, list(r.edges), r.rank)
    assert sorted(map(key, joined.collect())) == sorted(map(key, whole.collect()))
    assert G.links_to_adjacency_parts(links.where("src > 100"), 5).count() == 0


def hot_matrix(side, hot, light=400):
    """k = 0 holds ``hot`` cells, the others about one each."""
    r = random.Random(side)
    cells = {(i, 0): float(r.randint(1, 9)) for i in range(hot)}
    cells.update({(r.randint(0, hot), r.randint(1, light)): float(r.randint(1, 9)) for _ in range(2 * hot)})
    return [(i, k, v) for (i, k), v in cells.items()]


def test_hot_k_is_spread_over_all_tasks(spark):
    """A k with a third of both sides: tasks' pairs stay within twice the median, and the product is the same."""
    a = spark.createDataFrame(hot_matrix(1, 300), CELL)
    b = M.transpose(spark.createDataFrame(hot_matrix(2, 300), CELL))
    want = {(r.i, r.j): r.v for r in M.matmul_cells(a, b).collect()}
    assert {(r.i, r.j): r.v for r in M.matmul_cells_spread(a, b).collect()} == want
    assert 0 < M.k_blocks(a, b, 64).count() <= 64
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = {}
        for name, joined in (("plain", a.select("i", F.col("j").alias("k")).join(b.select(F.col("i").alias("k"), "j"), "k")),
                             ("spread", M.spread_pairs(a, b))):
            pairs[name] = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(pairs["plain"]) == sum(pairs["spread"])
    assert max(pairs["plain"]) > 0.9 * sum(pairs["plain"])
    assert len(pairs["spread"]) == 8 and max(pairs["spread"]) < 2 * np.median(pairs["spread"])


def test_spread_product_edges(spark):
    none = spark.createDataFrame([], CELL)
    some = spark.createDataFrame([(0, 5, 2.0)], CELL)
    assert M.matmul_cells_spread(none, some).count() == 0 and M.matmul_cells_spread(some, none).count() == 0
    assert [tuple(r) for r in M.matmul_cells_spread(some, M.transpose(some)).collect()] == [(0, 0, 4.0)]


def test_rows_are_read_from_their_blocks_only(spark):
    r = random.Random(4)
    cells = {(i, j): float(r.randint(1, 99)) for i in range(100) if not 40 <= i < 50 for j in r.sample(range(30), 3)}
    cells.update({(17, j): 1.0 for j in range(30)})         # a heavy row
    m = spark.createDataFrame([(i, j, v) for (i, j), v in cells.items()], CELL)
    path = shared_dir(spark, "test-blocks")
    write_row_blocks(m, path, 100, 30, 10)
    index = {x.block: x for x in block_index(spark, path).collect()}
    assert sum(x.cells for x in index.values()) == len(cells) and index[4].cells == 0
    assert index[3].start_row == 30 and index[3].elem_offset == 30 * 30 and index[3].n_rows == 10
    for a, b in ((0, 100), (15, 18), (39, 51), (40, 50), (99, 100), (20, 20), (90, 500)):
        got = read_rows(spark, path, a, b)
        assert {(x.i, x.j): x.v for x in got.collect()} == {(i, j): v for (i, j), v in cells.items() if a <= i < b}
        opened = {int(f.split("block=")[1].split("/")[0]) for f in got.inputFiles()}
        assert opened <= set(range(a // 10, -(-b // 10))) and (opened or a == b or (a, b) == (40, 50))
    # files of a block in name order hold its cells in order
    files = sorted(read_rows(spark, path, 10, 20).inputFiles())
    rows = [(x.i, x.j) for f in files for x in spark.read.parquet(f).collect()]
    assert rows == sorted(rows)
    with pytest.raises(M.ShapeError):
        read_rows(spark, path, 5, 3)


def test_broadcast_product_runs_in_many_tasks(spark):
    a = spark.createDataFrame([(i, j, 1.0) for i in range(64) for j in range(3)], CELL).coalesce(1)
    b = spark.createDataFrame([(j, 0, 1.0) for j in range(3)], CELL)
    out = M.matmul_broadcast(a, b, (3, 1))
    assert out.groupBy(F.spark_partition_id()).count().count() > 4
    assert {(r.i, r.j, r.v) for r in out.collect()} == {(i, 0, 3.0) for i in range(64)}
