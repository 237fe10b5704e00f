"""Iterative PageRank as a chain of DataFrame steps.

The update is computed on the link table, never on adjacency arrays:

    share(src)  = rank(src) / n_out(src)               one row per ranked site
    x(dst)      = sum over links src->dst of share(src) (partial + final agg)
    rank'(dst)  = 0.15 + 0.85 * x(dst)

Prepared once, before the loop:

* parallel links are collapsed into ``(src, dst, mult)`` with a map-side
  combined count, so a group of copies costs one row;
* ``deg(src, n_out, n_dst)`` is computed once and persisted.

Two physical strategies, chosen from a size check:

* ``broadcast`` - when the number of ranked sites is proven small, the
  ``share`` table is broadcast to the link partitions; the only shuffle per
  iteration is the partially aggregated contribution sum.
* ``salted`` - otherwise the links are hash-partitioned on ``(src, salt)``.
  A site with more than ``salt_bucket_rows`` distinct targets is spread over
  several salt buckets, and its ``share`` row is replicated once per bucket,
  so a hub never lands in one task.  The salted links are written once as a
  table bucketed on ``(src, salt)`` in the shared folder; its scan reports
  that hash partitioning, so each iteration shuffles only the site-sized
  ``share`` table (to the link buckets) and the partially aggregated
  contributions, never the links themselves.

Lineage is cut with reliable ``checkpoint()`` (into ``spark.checkpoint.dir``)
every ``checkpoint_every`` iterations (default: every one - the rank table is
node-sized, far smaller than the links, and a short plan keeps the driver's
re-optimisation cheap) and after the last, after which the cached link
tables are released.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.functions.rank import damp
from trellis.plans.sizing import BROADCAST_ROW_LIMIT, at_most, default_parallelism
from trellis.plans.tables import write_bucketed
from trellis.session import ensure_checkpoint_dir

STRATEGIES = ("auto", "broadcast", "salted")


class PreparedGraph:
    """Link table collapsed and annotated once, reused by every iteration."""

    def __init__(self, links: DataFrame, salt_bucket_rows: int = 1_000_000,
                 num_partitions: int | None = None):
        self.num_partitions = num_partitions or default_parallelism(links)
        self.salt_bucket_rows = salt_bucket_rows
        edges = (links.select("src", "dst").groupBy("src", "dst")
                 .agg(F.count(F.lit(1)).alias("mult")))
        deg = edges.groupBy("src").agg(F.sum("mult").alias("n_out"),
                                       F.count(F.lit(1)).alias("n_dst"))
        n_salt = F.greatest(F.lit(1), F.ceil(F.col("n_dst") / F.lit(salt_bucket_rows))).cast("int")
        self.deg = (deg.select("src", "n_out", n_salt.alias("n_salt"))
                    .repartition(self.num_partitions, "src")
                    .persist(StorageLevel.MEMORY_AND_DISK))
        self.edges = edges.persist(StorageLevel.MEMORY_AND_DISK)
        self._salted = None

    def salted_edges(self) -> DataFrame:
        if self._salted is None:
            salt = F.pmod(F.xxhash64("dst"), F.col("n_salt")).cast("int")
            salted = (self.edges.join(self.deg.select("src", "n_salt"), "src")
                      .select("src", salt.alias("salt"), "dst", "mult"))
            self._salted = write_bucketed(salted, self.num_partitions, ["src", "salt"], "links")
        return self._salted.scan()

    def unpersist(self) -> None:
        self.deg.unpersist()
        self.edges.unpersist()
        if self._salted is not None:
            self._salted.drop()
            self._salted = None


def _shares(graph: PreparedGraph, ranks: DataFrame) -> DataFrame:
    return (ranks.join(graph.deg, ranks["id"] == graph.deg["src"])
            .select("src", (F.col("rank") / F.col("n_out")).alias("share"), "n_salt"))


def step(graph: PreparedGraph, ranks: DataFrame, strategy: str,
         keep_unlinked: bool = False) -> DataFrame:
    """One update over a prepared graph; ``keep_unlinked`` selects G9 over G8."""
    shares = _shares(graph, ranks)
    if strategy == "broadcast":
        contrib = graph.edges.join(F.broadcast(shares.select("src", "share")), "src")
    else:
        replicated = shares.select(
            "src", "share", F.explode(F.sequence(F.lit(0), F.col("n_salt") - 1)).alias("salt"))
        contrib = graph.salted_edges().join(replicated, ["src", "salt"])
    summed = (contrib.groupBy(F.col("dst").alias("id"))
              .agg(F.sum(F.col("share") * F.col("mult")).alias("x")))
    if keep_unlinked:
        return (ranks.select("id").join(summed, "id", "left")
                .select("id", damp(F.coalesce("x", F.lit(0.0))).alias("rank")))
    return summed.select("id", damp("x").alias("rank"))


def choose_strategy(graph: PreparedGraph, ranks: DataFrame, strategy: str = "auto",
                    row_limit: int = BROADCAST_ROW_LIMIT) -> str:
    """Broadcast only when both the degree table and the start ranks are
    proven to hold at most ``row_limit`` rows (every later share table is
    bounded by one of them)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy != "auto":
        return strategy
    small = at_most(graph.deg, row_limit) and at_most(ranks, row_limit)
    return "broadcast" if small else "salted"


def pagerank(links: DataFrame, ranks: DataFrame, iterations: int = 5,
             keep_unlinked: bool = False, checkpoint_every: int = 1,
             strategy: str = "auto", salt_bucket_rows: int = 1_000_000,
             row_limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """``iterations`` updates of ``ranks(id, rank)`` over ``links(src, dst)``.

    No convergence test, as in the reference.  With ``keep_unlinked=False``
    (the reference's step) sites without an in-link drop out after a step.
    """
    graph = PreparedGraph(links, salt_bucket_rows=salt_bucket_rows)
    done = False
    try:
        chosen = choose_strategy(graph, ranks, strategy, row_limit)
        if checkpoint_every:
            ensure_checkpoint_dir(links.sparkSession)
        current = ranks.select("id", F.col("rank").cast("double").alias("rank"))
        for it in range(1, iterations + 1):
            current = step(graph, current, chosen, keep_unlinked)
            if checkpoint_every and (it % checkpoint_every == 0 or it == iterations):
                current = current.checkpoint(eager=True)
        done = True
    finally:
        if checkpoint_every or not done:
            # the checkpointed result no longer depends on the link tables
            graph.unpersist()
    return current
