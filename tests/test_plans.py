"""Session settings, size checks and strategy choices."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from trellis.operators import matrix as M
from trellis.plans import matmul as MM
from trellis.plans import pagerank as PR
from trellis.plans.pagerank import PreparedGraph, choose_strategy
from trellis.plans.sizing import at_most
from trellis.plans.tables import write_bucketed
from trellis.session import ensure_checkpoint_dir, shared_dir


def test_checkpoint_dir_is_set_once(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    base = spark.conf.get("spark.checkpoint.dir")
    assert a != b and a.startswith(base.rstrip("/")) and b.startswith(base.rstrip("/"))


def test_at_most(spark):
    df = spark.range(1000)
    assert at_most(df, 1000) and not at_most(df, 999)
    assert at_most(df.where("id < 0"), 0)


def test_pagerank_strategy_follows_size(spark):
    links = spark.createDataFrame([(i, (i + 1) % 50) for i in range(50)], "src bigint, dst bigint")
    ranks = spark.range(50).select("id", F.lit(1.0).alias("rank"))
    g = PreparedGraph(links)
    assert choose_strategy(g, ranks, "auto", row_limit=100) == "broadcast"
    assert choose_strategy(g, ranks, "auto", row_limit=10) == "salted"
    assert choose_strategy(g, ranks, "salted") == "salted"
    g.unpersist()


def test_bucketed_table_avoids_reshuffle(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("src"), (F.col("id") % 3).alias("salt"), "id")
    table = write_bucketed(df.repartition(6), 4, ["src", "salt"], "test")
    t = table.scan()
    folder = table.path.removeprefix("file:")
    assert len(glob.glob(f"{folder}/*.parquet")) <= 4     # a file for each bucket, not for each task
    other = spark.range(50).select((F.col("id") % 7).alias("src"), (F.col("id") % 3).alias("salt"),
                                   F.col("id").alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t.join(other, ["src", "salt"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the bucketed side is read as-is; only the other side is exchanged
    assert plan.count("Exchange hashpartitioning") == 1
    assert t.join(other, ["src", "salt"]).count() == df.join(other, ["src", "salt"]).count()
    table.drop()
    assert table.name not in {x.name for x in spark.catalog.listTables()}
    assert not os.path.exists(folder)
    table.drop()


def test_failed_bucketed_write_leaves_nothing(spark):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    bad = spark.range(10).select(F.col("id").alias("src"), F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        write_bucketed(bad, 2, ["src"], "broken")
    assert not glob.glob(f"{base}/broken-*")


def test_salted_pagerank_releases_its_links(spark):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    links = spark.createDataFrame([(i % 5, i) for i in range(60)], "src bigint, dst bigint")
    ranks = spark.range(60).select("id", F.lit(1.0).alias("rank"))
    PR.pagerank(links, ranks, 2, strategy="salted", salt_bucket_rows=4)
    assert not glob.glob(f"{base}/links-*")
    with pytest.raises(ValueError):
        PR.pagerank(links, ranks, 2, strategy="none")


def test_no_shared_folder_on_a_cluster_raises(spark):
    class Context:
        master = "spark://elsewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_matmul_strategy_choice():
    assert MM.choose((1, 1), (1, 1), 1) == "broadcast"
    assert MM.choose((1000, 1000), (1000, 1000), 1, broadcast_cells=10) == "cells"
    assert MM.choose((10, 10), (10, 10), 100, broadcast_cells=10) == "blocked"
    assert MM.choose((300_000, 300_000), (300_000, 300_000), 5) == "cells"
    assert MM.choose((300_000, 300_000), (300_000, 300_000), 10 ** 10) == "blocked"


def test_declared_shape_above_2_to_31_cells(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (299_999, 299_999, 2.0)], "i bigint, j bigint, v double")
    got = sorted(tuple(r) for r in MM.matmul(a, a, (300_000, 300_000), (300_000, 300_000)).collect())
    assert got == [(0, 0, 1.0), (299_999, 299_999, 4.0)]


def test_large_right_side_takes_the_blocked_way(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "i bigint, j bigint, v double")
    b = spark.createDataFrame([(0, 0, 1.0), (1, 0, 1.0)], "i bigint, j bigint, v double")
    for cells in (1, 10):
        assert [tuple(r) for r in M.matmul_broadcast(a, b, (2, 1), max_cells=cells).collect()] == [(0, 0, 3.0)]


def test_tall_times_thin_spreads_over_partitions(spark):
    n = 4000
    a = spark.range(n * 8).select((F.col("id") % n).alias("i"), F.expr(f"id div {n}").alias("j"), F.lit(1.0).alias("v"))
    b = spark.range(64).select(F.expr("id div 8").alias("i"), (F.col("id") % 8).alias("j"), F.lit(1.0).alias("v"))
    out = M.matmul_blocked(a, b, num_partitions=8)
    assert out.count() == n * 8 and out.where("v != 8").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(bk" in plan and "salt" in plan
