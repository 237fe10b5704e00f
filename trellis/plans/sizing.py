"""Size checks that guard every explicit broadcast.

A side is broadcast only when it is proven to hold at most ``limit`` rows.
The check is a plain count: it is combined map-side, so no partition ever
gathers rows for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Default bound on rows of a broadcast side: keyed doubles/longs of ~24 bytes
# a row keep this well below Spark's 8 GB broadcast ceiling and typical
# executor memory.
BROADCAST_ROW_LIMIT = 2_000_000


def at_most(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has no more than ``limit`` rows."""
    return df.count() <= limit


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the cluster's cores where their scan has fewer tasks: before
    an explode whose work is far more than the bytes that are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def default_parallelism(df: DataFrame) -> int:
    spark = df.sparkSession
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
