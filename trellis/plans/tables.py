"""Materialised intermediate tables in the shared folder.

A bucketed table keeps its hash partitioning across jobs: a later join on
the bucket columns shuffles only the other side.  Writing it also cuts the
lineage, so a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from trellis.session import delete_dir, ensure_checkpoint_dir, shared_dir


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the checkpoint folder: its lineage is cut,
    a lost executor costs a re-read, and Spark's cleaner removes the files when
    nothing refers to them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


class BucketedTable:
    """A bucketed table below the shared folder: its scan, and its removal."""

    def __init__(self, spark, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path

    def scan(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Remove the catalog entry and the files; harmless if repeated."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_dir(self.spark, self.path)


def write_bucketed(df: DataFrame, num_buckets: int, columns: list, label: str) -> BucketedTable:
    """Write ``df`` bucketed on ``columns`` below the shared folder.

    The rows are dealt out by the bucket columns first, so each bucket is one
    file, not one for each task.  The table is registered under a unique name
    (bucketing needs a catalog entry) until ``drop``.
    """
    spark = df.sparkSession
    table = BucketedTable(spark, f"trellis_{label}_{uuid.uuid4().hex[:12]}", shared_dir(spark, label))
    try:
        (df.repartition(num_buckets, *columns).write.format("parquet").bucketBy(num_buckets, *columns)
         .option("path", table.path).saveAsTable(table.name))
    except Exception:
        table.drop()
        raise
    return table
