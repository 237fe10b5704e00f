"""Serving requests as a Structured Streaming job (R5) and counting
completed requests per event-time window (R6, streaming form).

The request feed is unbounded; each micro-batch is parsed, rejected rows
are dropped, and the rest is left-joined to the (static) file catalog -
a stateless stream-static join, so no state grows with the stream.  The
catalog side is read once (``prepare_catalog``): kept in memory and broadcast
when proven small, else a table bucketed on the path key.  Output
is appended to a parquet sink; the checkpoint location makes the sink
exactly-once across restarts and lost executors.  The static side is a
snapshot: a restart picks up new files.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trellis.operators.catalog import keyed_files
from trellis.operators.requests import serve
from trellis.plans.sizing import spread
from trellis.plans.tables import write_bucketed
from trellis.session import publish_once, shared_dir
from trellis.sources import views
from trellis.streaming import late

EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def request_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` files of a folder read as a stream, turned into request lines.

    The folder is the feed: every ``events*.parquet`` file landing in it is a
    new micro-batch input.  A folder pattern (``feed/*``) reads every parquet file in
    the folders that match.
    """
    reader = spark.readStream.schema(EVENTS_SCHEMA).option(
        "pathGlobFilter", "*.parquet" if sf_dir.endswith("*") else "events*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(sf_dir)
    return views.request_lines(events)


class PreparedCatalog:
    """The lookup side of a stream-static join, prepared once for all
    micro-batches; ``release`` frees it when the query has ended."""

    def __init__(self, table: DataFrame, free):
        self.table = table
        self._free = free

    def release(self) -> None:
        self._free()


def prepare_catalog(files: DataFrame, broadcast_rows: int = 1_000_000,
                    broadcast_bytes: int = 256 * 1024 * 1024,
                    num_buckets: int | None = None) -> PreparedCatalog:
    """A catalog proven small (rows and total content bytes) is kept in memory
    and broadcast to each micro-batch; otherwise it is written once as a table
    bucketed on the path key, so a micro-batch shuffles only its own requests,
    never the catalog.  Either way the files are read once, not per batch.
    """
    keyed = keyed_files(files).persist(StorageLevel.MEMORY_AND_DISK)
    stats = keyed.agg(F.count(F.lit(1)).alias("n"),
                      F.coalesce(F.sum(F.octet_length("contents")), F.lit(0)).alias("size")).first()
    if stats["n"] <= broadcast_rows and stats["size"] <= broadcast_bytes:
        return PreparedCatalog(F.broadcast(keyed), keyed.unpersist)
    n = num_buckets or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = write_bucketed(keyed, n, ["_key"], "catalog")
    keyed.unpersist()
    return PreparedCatalog(table.scan(), table.drop)


def serve_stream(requests: DataFrame, files: DataFrame, out_dir: str, checkpoint_dir: str,
                 available_now: bool = False, processing_time: str | None = None,
                 keyed: DataFrame | None = None) -> StreamingQuery:
    """Append ``(request_id, ts, driver, path, status, body)`` rows as requests
    arrive.  ``keyed`` is the table of a ``prepare_catalog`` that the caller
    releases; without it the catalog is joined as it is."""
    served = serve(requests, files, keyed=keyed)
    writer = (served.writeStream.format("parquet").outputMode("append")
              .option("path", out_dir).option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def completed_stream(responses: DataFrame, out_dir: str, checkpoint_dir: str,
                     window: str = "10 seconds", lateness: str | None = None,
                     available_now: bool = False) -> StreamingQuery:
    """R6 streaming form: completed requests per tumbling window and driver.

    Every micro-batch writes the new counts of the windows it changed below
    ``out_dir``, in a folder of its own that a repeated batch replaces;
    ``completed_counts`` reads the latest count of each.  However the feed is
    cut into batches, the counts are those of the batch form.

    ``ts`` arrives as ``timestamp_ntz``; it is read as a UTC timestamp.
    ``lateness`` is the caller's: with it, windows older than the watermark are
    closed, their state is freed and later rows for them are not counted;
    without it nothing is ever dropped and state holds one row per window and
    driver.
    """
    timed = responses.withColumn("event_time", F.col("ts").cast("timestamp"))
    if lateness:
        timed = timed.withWatermark("event_time", lateness)
    counted = (timed.groupBy(F.window("event_time", window).alias("w"), "driver")
               .agg(F.count(F.lit(1)).alias("n"))
               .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "driver", "n"))

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    writer = counted.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def completed_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The latest ``(window_start, driver, n)`` that ``completed_stream`` wrote."""
    rows = (spark.read.schema("window_start timestamp_ntz, driver bigint, n bigint, batch bigint")
            .option("basePath", out_dir).parquet(f"{out_dir}/batch=*"))
    return (rows.groupBy("window_start", "driver").agg(F.max_by("n", "batch").alias("n"))
            .select("window_start", "driver", "n"))


def serve_available(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Run R5 over everything currently in the feed; return the sink's rows."""
    out = shared_dir(spark, "serve-out")
    files = views.files(spark, sf_dir)
    catalog = prepare_catalog(files)
    try:
        q = serve_stream(request_stream(spark, sf_dir, max_files_per_trigger), files, out,
                         shared_dir(spark, "serve-ckpt"), available_now=True, keyed=catalog.table)
        q.awaitTermination()
    finally:
        catalog.release()
    return spark.read.parquet(out)


class CompletedRun:
    """R5 -> R6 over a feed of ``events*.parquet`` files that grows between calls of
    ``advance``.  With a ``lateness`` the state is bounded: rows pass the gate of
    ``trellis.streaming.late`` and windows close.  Only whether a request
    completes matters, so no contents are read."""

    def __init__(self, spark: SparkSession, feed: str, files: DataFrame, lateness: str | None = None,
                 max_files_per_trigger: int | None = None):
        self.spark, self.feed, self.lateness, self.per_trigger = spark, feed, lateness, max_files_per_trigger
        self.files = files.select("path", F.lit("").alias("contents"))
        names = ("completed-out", "completed-ckpt", "completed-gate", "completed-gate-ckpt")
        self.out, self.checkpoint, self.gate, self.gate_checkpoint = (shared_dir(spark, n) for n in names)
        self.dropped = 0

    def advance(self) -> StreamingQuery:
        """Count what has come since; returns the counting query, ended."""
        catalog = prepare_catalog(self.files)
        try:
            served = serve(request_stream(self.spark, self.feed, self.per_trigger), self.files, keyed=catalog.table)
            if self.lateness:
                late.admit_stream(served, self.gate, self.gate_checkpoint, self.lateness, available_now=True).awaitTermination()
                served = late.admitted_stream(self.spark, self.gate)
            q = completed_stream(served, self.out, self.checkpoint, lateness=self.lateness, available_now=True)
            q.awaitTermination()
        finally:
            catalog.release()
        self.dropped += late.dropped_by_watermark(q)
        return q

    def counts(self) -> DataFrame:
        return completed_counts(self.spark, self.out)

    def late_rows(self) -> DataFrame:
        return late.late_rows(self.spark, self.gate)


def completed_available(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None,
                        lateness: str | None = None) -> DataFrame:
    """Run R5 -> R6 (streaming) over everything in the feed; return the counts."""
    run = CompletedRun(spark, sf_dir, views.files(spark, sf_dir), lateness, max_files_per_trigger)
    run.advance()
    return run.counts()


def completed_arrivals(spark: SparkSession, sf_dir: str, lateness: str) -> DataFrame:
    """R6 over a feed that arrives in ``views.ARRIVALS`` parts, some rows of each a part too
    late: ``(window_start, driver, n, n_late)`` of counted and of late requests."""
    feed = shared_dir(spark, "feed")
    run = CompletedRun(spark, f"{feed}/*", views.files(spark, sf_dir), lateness)
    events = views.arrivals(spark, sf_dir)
    for k in range(views.ARRIVALS):
        put_arrival(events.where(F.col("arrival") == k), feed, k)
        run.advance()
    if run.dropped:
        raise RuntimeError(f"{run.dropped} admitted rows were dropped")
    missed = late.late_counts(run.late_rows())
    keys = ["window_start", "driver"]
    both = run.counts().select(*keys, "n", F.lit(0).alias("n_late")).unionByName(missed.select(*keys, F.lit(0).alias("n"), "n_late"))
    return both.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late"))


def put_arrival(events: DataFrame, feed: str, k: int) -> None:
    """Put one part of a feed where ``request_stream`` finds it, in whole files: as many as the
    cluster has cores at least, since a file's row group is read by one task."""
    spark = events.sparkSession
    staged = shared_dir(spark, "arrival")
    spread(events.drop("arrival")).write.parquet(staged)
    publish_once(spark, staged, f"{feed}/events-{k}.parquet")
