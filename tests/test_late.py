"""Counting with bounded state: late rows, replays, restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trellis.operators import requests as R
from trellis.session import shared_dir
from trellis.sources import views
from trellis.streaming import late
from trellis.streaming.serve import completed_arrivals, completed_available, completed_counts, completed_stream, put_arrival

SF = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)
ROWS = "request_id bigint, ts timestamp_ntz, driver bigint"


class Feed:
    """Rows of (request_id, second, driver) in arrivals; gate and counts over them."""

    def __init__(self, spark, lateness):
        self.spark, self.lateness, self.n = spark, lateness, 0
        self.feed, self.gate, self.gate_ckpt, self.out, self.ckpt = (shared_dir(spark, f"late-{x}") for x in "abcde")

    def arrive(self, rows):
        data = [(i, None if s is None else START + dt.timedelta(seconds=s), d) for i, s, d in rows]
        self.spark.createDataFrame(data, ROWS).coalesce(1).write.parquet(f"{self.feed}/{self.n}")
        self.n += 1

    def admit(self):
        stream = self.spark.readStream.schema(ROWS).option("recursiveFileLookup", True).parquet(self.feed)
        late.admit_stream(stream, self.gate, self.gate_ckpt, self.lateness, available_now=True).awaitTermination()

    def count(self):
        q = completed_stream(late.admitted_stream(self.spark, self.gate), self.out, self.ckpt, lateness=self.lateness, available_now=True)
        q.awaitTermination()
        return q

    def counts(self):
        return {(int((r.window_start - START).total_seconds()), r.driver): r.n for r in completed_counts(self.spark, self.out).collect()}

    def late(self):
        return sorted((r.request_id, r.reason, r.batch) for r in late.late_rows(self.spark, self.gate).collect())


def test_late_rows_are_kept_counted_and_state_is_freed(spark):
    f = Feed(spark, "30 seconds")
    arrivals = [
        [(1, 0, 7), (2, 5, 7), (3, 12, 7), (4, 100, 8)],        # high 100: watermark 70
        [(5, 71, 7), (6, 69, 7), (7, 55, 7), (8, 200, None), (9, None, 7)],  # 55: window 50-60 had closed, 60-70 too; 71 counts
        [(10, 71, 7), (11, 170, 7), (12, 165, 7), (13, 201, None)],           # watermark 170: 160-170 had closed
    ]
    held = []
    for rows in arrivals:
        f.arrive(rows)
        f.admit()
        q = f.count()
        assert late.dropped_by_watermark(q) == 0
        held.append(late.state_rows(q))
    assert f.late() == [(6, "late", 1), (7, "late", 1), (9, "no_time", 1), (10, "late", 2), (12, "late", 2)]
    assert f.counts() == {(0, 7): 2, (10, 7): 1, (100, 8): 1, (70, 7): 1, (200, None): 2, (170, 7): 1}
    assert held[-1] <= 3                                     # windows closed by the watermark are not held
    counted = late.late_counts(late.late_rows(spark, f.gate)).collect()
    assert {(r.window_start and int((r.window_start - START).total_seconds()), r.driver, r.n_late) for r in counted} == {
        (60, 7, 1), (50, 7, 1), (None, 7, 1), (70, 7, 1), (160, 7, 1)}


def test_state_does_not_grow_with_the_stream(spark):
    f = Feed(spark, "20 seconds")
    held = []
    for k in range(5):
        f.arrive([(100 * k + i, 100 * k + 10 * i, i % 2) for i in range(10)])
        f.admit()
        held.append(late.state_rows(f.count()))
    assert sum(f.counts().values()) == 50 and f.late() == []
    assert max(held[1:]) <= held[0] + 3 and held[-1] < 50 / 2


def test_a_repeated_micro_batch_changes_nothing(spark):
    """The gate's checkpoint loses its last commit, so the micro-batch runs again."""
    import glob
    import os
    f = Feed(spark, "30 seconds")
    f.arrive([(1, 0, 1), (2, 100, 1)])
    f.admit()
    f.arrive([(3, 3, 1), (4, 110, 1)])
    f.admit()
    before = f.late()
    f.count()
    counts = f.counts()
    folder = f.gate_ckpt.replace("file:", "") + "/commits"
    for name in (f"{folder}/1", *glob.glob(f"{folder}/.1.crc")):
        os.remove(name)
    f.admit()
    f.count()
    assert f.late() == before == [(3, "late", 1)] and f.counts() == counts == {(0, 1): 1, (100, 1): 1, (110, 1): 1}


def test_a_gate_without_its_mark_fails_loudly(spark):
    f = Feed(spark, "30 seconds")
    f.arrive([(1, 0, 1)])
    f.admit()
    f.gate = shared_dir(spark, "late-elsewhere")             # same checkpoint, another folder
    f.arrive([(2, 0, 1)])
    with pytest.raises(Exception, match="no mark of micro-batch 0"):
        f.admit()


def test_bounded_counts_equal_the_batch_form_where_nothing_is_late(spark):
    served = R.serve(views.requests(spark, SF), views.files(spark, SF))
    want = sorted(map(tuple, R.completed_requests(served).where("level = 0").drop("level").collect()), key=str)
    got = completed_available(spark, SF, lateness="1 hour")
    assert sorted(map(tuple, got.select("window_start", "driver", "n").collect()), key=str) == want


def test_arrivals_are_counted_or_late(spark):
    served = R.serve(views.requests(spark, SF), views.files(spark, SF)).count()
    out = completed_arrivals(spark, SF, "5 days").collect()
    n, missed = sum(r.n for r in out), sum(r.n_late for r in out)
    assert n + missed == served and n > 0 and missed > 0


def test_a_part_of_one_row_group_is_put_in_files_for_all_cores(spark):
    events = spark.range(4000).coalesce(1).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("user_id"), F.lit("x").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"),
        F.lit(0).alias("arrival"))
    feed = shared_dir(spark, "test-feed")
    put_arrival(events, feed, 0)
    put = spark.read.parquet(f"{feed}/events-0.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert len(put.inputFiles()) >= cores and put.count() == 4000
    assert put.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] < 2 * 4000 / cores
