"""Serving a stream from a catalog that changes meanwhile.

The reference looks a path up when the request comes.  Here every micro-batch is
served from the newest version of a ``CatalogTable`` at its start.  The version is
written down first, once for each micro-batch, and the answers are put in a folder
that is renamed once; so a micro-batch that is run again answers from the same
version, and each request has one answer.

The lookup side is kept between micro-batches (``LiveCatalog``) as segments: a new version
adds the segment of what was committed since, which alone is read.  As a table
names every node once, a request finds its path in one segment at most, and the
segments are joined one after another: small ones broadcast, large ones from
buckets, so that a micro-batch shuffles its own requests only.  Past ``SEGMENTS``
of them they are made one again.  What is kept grows with the catalog's names, never
with the requests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trellis.operators.requests import serve
from trellis.plans.sizing import spread
from trellis.session import create_once, publish_once, read_text, shared_dir
from trellis.sources import views
from trellis.sources.catalog_log import CatalogTable
from trellis.streaming.serve import PreparedCatalog, prepare_catalog, put_arrival, request_stream

SEGMENTS = 8


class LiveCatalog:
    """The lookup side of a catalog table, brought to a version segment by segment."""

    def __init__(self, table: CatalogTable, segments: int = SEGMENTS, **limits):
        self.table, self.most, self.limits = table, segments, limits
        self.held: list[tuple[int, PreparedCatalog]] = []       # last version of each segment

    def at(self, version: int) -> list[DataFrame]:
        """Lookup tables that hold exactly the names of ``version``."""
        newest = self.held[-1][0] if self.held else 0
        if version < newest or len(self.held) >= self.most and version > newest:
            self.release()                                      # an older version, or too many segments
            newest = 0
        if version > newest:
            self.held.append((version, prepare_catalog(self.table.files(version, after=newest), **self.limits)))
        return [p.table for _, p in self.held]

    def release(self) -> None:
        for _, prepared in self.held:
            prepared.release()
        self.held = []


def serve_live(requests: DataFrame, catalog: LiveCatalog, out_dir: str, checkpoint_dir: str, available_now: bool = False,
               before_answer=None) -> StreamingQuery:
    """Append ``(request_id, ts, driver, path, status, body, version)`` rows below ``out_dir``.

    ``before_answer`` is called after the version is written down (tests fail there)."""
    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note = f"{out_dir}/versions/{batch_id:010d}"
        chosen = read_text(spark, note)
        if chosen is None:
            create_once(spark, note, str(catalog.table.version()))
            chosen = read_text(spark, note)
        if before_answer:
            before_answer(batch_id)
        version = int(chosen)
        served = serve(spread(batch), catalog.table.files(0), keyed=catalog.at(version))
        staged = f"{out_dir}/staged/{uuid.uuid4().hex}"
        served.withColumn("version", F.lit(version).cast("bigint")).write.parquet(staged)
        publish_once(spark, staged, f"{out_dir}/answers/batch={batch_id:010d}")

    writer = requests.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def answers(spark: SparkSession, out_dir: str) -> DataFrame:
    """Everything that ``serve_live`` has answered."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{out_dir}/answers")


def serve_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in ``views.ARRIVALS`` parts: the first is served from the English files, those of
    the other languages are committed after it."""
    table = CatalogTable(spark, shared_dir(spark, "catalog"))
    docs = views.document_files(spark, sf_dir).withColumn("seq", F.col("doc_id"))
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    table.insert(docs.where(english), "english")
    feed, out, checkpoint = (shared_dir(spark, n) for n in ("live-feed", "live-out", "live-ckpt"))
    catalog = LiveCatalog(table)
    events = views.arrivals(spark, sf_dir)
    try:
        for k in range(views.ARRIVALS):
            if k == 1:
                table.insert(docs.where(~english), "others")
            put_arrival(events.where(F.col("arrival") == k), feed, k)
            serve_live(request_stream(spark, f"{feed}/*"), catalog, out, checkpoint, available_now=True).awaitTermination()
    finally:
        catalog.release()
    return answers(spark, out)
