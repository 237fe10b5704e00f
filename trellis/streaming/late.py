"""Counting a stream with bounded state, and keeping what came too late.

A watermark lets Spark free the state of closed windows, but what arrives for them
afterwards is dropped without trace.  So the feed passes a gate first
(``admit_stream``): micro-batch by micro-batch, rows whose window had closed when
they came go to a dead-letter table with the watermark they missed, rows without a
time too, and the others to the admitted feed that is counted
(``completed_stream`` with the same lateness).

The gate's watermark is Spark's own rule: the latest time of all earlier
micro-batches less the lateness; a window is closed when its end is not after it.
Its only state is that time, one line a micro-batch, of which two are kept.  Every
folder of a micro-batch is written aside and renamed once, so a repeated
micro-batch changes nothing.  The counting query reads the admitted files in the
order in which they came and its watermark is never ahead of the gate's, so Spark drops
nothing there; ``dropped_by_watermark`` is the audit of that.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trellis.session import create_once, delete_dir, publish_once, read_text

ADMITTED_SCHEMA = "request_id bigint, ts timestamp_ntz, driver bigint"
LATE_SCHEMA = "request_id bigint, ts timestamp_ntz, driver bigint, reason string, watermark timestamp_ntz, batch bigint"


def _mark(out_dir: str, batch_id: int) -> str:
    return f"{out_dir}/marks/{batch_id}"


def admit_stream(rows: DataFrame, out_dir: str, checkpoint_dir: str, lateness: str, window: str = "10 seconds",
                 available_now: bool = False) -> StreamingQuery:
    """Part ``(request_id, ts, driver)`` rows into ``out_dir/admitted`` and
    ``out_dir/late`` (``LATE_SCHEMA``), a folder for each micro-batch."""
    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_text(spark, _mark(out_dir, batch_id - 1)) if batch_id else ""
        if before is None:
            raise RuntimeError(f"{out_dir} has no mark of micro-batch {batch_id - 1}")
        batch = batch.select("request_id", "ts", "driver").persist(StorageLevel.MEMORY_AND_DISK)
        high = F.lit(before or None).cast("timestamp_ntz")
        watermark = high - F.expr(f"INTERVAL {lateness}")
        closes = F.window("ts", window)["end"]
        judged = batch.where("ts is not null").withColumn("late", F.coalesce(closes <= watermark, F.lit(False)))
        late = judged.where("late").select("request_id", "ts", "driver", F.lit("late").alias("reason"))
        none = batch.where("ts is null").select("request_id", "ts", "driver", F.lit("no_time").alias("reason"))
        parts = {"admitted": judged.where("not late").select("request_id", "ts", "driver"),
                 "late": late.unionByName(none).select("*", watermark.alias("watermark"), F.lit(batch_id).cast("bigint").alias("batch"))}
        for kind, part in parts.items():
            staged = f"{out_dir}/staged/{uuid.uuid4().hex}"
            part.write.parquet(staged)
            publish_once(spark, staged, f"{out_dir}/{kind}/batch={batch_id:010d}")
        now = batch.agg(F.greatest(F.max("ts"), high).cast("string").alias("high")).first()["high"]
        batch.unpersist()
        create_once(spark, _mark(out_dir, batch_id), now or "")
        if batch_id > 1:
            delete_dir(spark, _mark(out_dir, batch_id - 2))     # the last one stays for a repeated micro-batch

    writer = rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def admitted_stream(spark: SparkSession, out_dir: str) -> DataFrame:
    """The admitted rows as a stream, in the order of the micro-batches."""
    return (spark.readStream.schema(ADMITTED_SCHEMA).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").parquet(f"{out_dir}/admitted"))


def late_rows(spark: SparkSession, out_dir: str) -> DataFrame:
    """The dead-letter table."""
    return (spark.read.schema(LATE_SCHEMA).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").parquet(f"{out_dir}/late"))


def late_counts(late: DataFrame, window: str = "10 seconds") -> DataFrame:
    """``(window_start, driver, n_late)``: what each closed window missed; rows without a
    time under a null window."""
    start = F.when(F.col("ts").isNotNull(), F.date_trunc("MICROSECOND", F.window(F.coalesce("ts", F.lit("1970-01-01").cast("timestamp_ntz")), window)["start"]))
    return late.groupBy(start.cast("timestamp_ntz").alias("window_start"), "driver").agg(F.count(F.lit(1)).alias("n_late"))


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that Spark's own watermark dropped, over the query's recent progress."""
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)


def state_rows(query: StreamingQuery) -> int:
    """Rows of state that the query held after its last micro-batch."""
    last = query.lastProgress
    return sum(int(op.numRowsTotal) for op in last.stateOperators) if last else 0
