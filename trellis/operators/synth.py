"""Seeded generators: start ranks, random link tables and integer matrices.

All of them are projections over existing rows (or ``spark.range``) with the
portable hash of ``trellis.functions.hashing``; nothing is generated on the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.functions.hashing import mix

DISTRIBUTIONS = ("uniform", "increasing", "random")


def initial_ranks(nodes: DataFrame, seed: int = 42) -> DataFrame:
    """One start rank in [0, 100) per node id."""
    h = mix("id", 0, seed)
    return nodes.select("id", ((h % 1000000).cast("double") / F.lit(10000.0)).alias("rank"))


def synth_links(nodes: DataFrame, n: int, lo: int, hi: int, dist: str = "uniform",
                seed: int = 42) -> DataFrame:
    """Seeded link table over node ids ``0..n-1``.

    Out-degree rules: ``uniform`` = hi; ``increasing`` = lo + trunc((hi-lo)*id/n);
    ``random`` = lo + r with r in [0, hi-lo) (so hi itself is never drawn).
    Targets are uniform over ``0..n-1``; parallel links and self-loops occur.
    """
    if dist not in DISTRIBUTIONS:
        raise ValueError(f"dist must be one of {DISTRIBUTIONS}")
    if n <= 0:
        raise ValueError("n must be positive")
    i = F.col("id")
    if dist == "uniform":
        n_out = F.lit(hi)
    elif dist == "increasing":
        frac = i.cast("double") / F.lit(float(n))
        n_out = F.lit(lo) + (F.lit(float(hi - lo)) * frac).cast("int")
    else:
        span = hi - lo
        n_out = F.lit(lo) + (mix(i, 0, seed + 1) % F.lit(span) if span > 0 else F.lit(0))
    n_out = n_out.cast("int")
    js = F.when(n_out > 0, F.sequence(F.lit(0), n_out - 1)).otherwise(F.array().cast("array<int>"))
    return (nodes.select(i.alias("src"), F.explode(js).alias("j"))
            .select("src", (mix("src", F.col("j") + 1, seed) % F.lit(n)).alias("dst")))


def synth_values(positions: DataFrame, seed: int = 314) -> DataFrame:
    """M15 over given positions ``(i, j)``: integers 0..99 held as double."""
    return positions.select("i", "j", (mix("i", "j", seed) % 100).cast("double").alias("v"))


def synth_matrix(spark: SparkSession, nrows: int, ncols: int, seed: int = 314) -> DataFrame:
    """Dense ``nrows x ncols`` matrix in cell form, generated in tasks."""
    cells = spark.range(nrows * ncols).select(
        F.expr(f"id div {int(ncols)}").alias("i"), (F.col("id") % ncols).alias("j"))
    return synth_values(cells, seed)
