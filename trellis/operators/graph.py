"""Link-graph operators (adjacency form and link-table form).

Two shapes of the same graph are supported:

* ``sites(id, edges array<bigint>)`` - one row per site, parallel links kept
  in the array (the reference's data model);
* ``links(src, dst)`` - one row per link.

The array form is convenient for small graphs; at scale the link form is the
one to compute on (a hub site never becomes one huge array), and
``trellis.plans.pagerank`` uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trellis.functions.rank import damp
from trellis.plans.tables import stored


# ---------------------------------------------------------------- conversions

def adjacency_to_links(sites: DataFrame) -> DataFrame:
    """G1: one row per out-link; a site with an empty list yields no row."""
    return sites.select(F.col("id").alias("src"), F.explode("edges").alias("dst"))


def links_to_adjacency(nodes: DataFrame, links: DataFrame, sort_edges: bool = True) -> DataFrame:
    """``(id, edges)`` for every node; linkless nodes get an empty list.

    ``nodes`` has an ``id`` column.  ``collect_list`` is partially aggregated
    map-side; ``sort_edges`` makes the list order deterministic (the order of
    appends is not defined once links are shuffled).

    The array form holds a site's whole out-list in one row, as the
    reference's data model does, so a hub becomes one large row.  It is for
    exchange only, where a result is defined as whole lists; everything else
    runs on the link table or on ``links_to_adjacency_chunks``.
    """
    grouped = links.groupBy(F.col("src").alias("id")).agg(F.collect_list("dst").alias("edges"))
    if sort_edges:
        grouped = grouped.select("id", F.array_sort("edges").alias("edges"))
    empty = F.array().cast("array<bigint>")
    return (nodes.select("id").join(grouped, "id", "left")
            .select("id", F.coalesce(F.col("edges").cast("array<bigint>"), empty).alias("edges")))


def links_to_adjacency_chunks(links: DataFrame, chunk: int = 100_000) -> DataFrame:
    """G2 for graphs with hubs: ``(id, part, edges)``, a site's targets spread by
    hash over as many parts as keep each near ``chunk`` links, so no row and no
    group grows with a hub.  Parallel links are counted first and dealt in pieces
    of at most a quarter of ``chunk``, so a target linked often is spread too."""
    piece = max(1, chunk // 4)
    pairs = links.groupBy(F.col("src").alias("id"), "dst").agg(F.count(F.lit(1)).alias("mult"))
    deg = pairs.groupBy("id").agg(F.ceil(F.sum("mult") / F.lit(chunk)).cast("int").alias("parts"))
    pieces = pairs.select("id", "dst", "mult", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("mult") - 1) / F.lit(piece)))).alias("nth"))
    dealt = (pieces.join(deg, "id").withColumn("part", F.pmod(F.xxhash64("dst", "nth"), F.col("parts")).cast("int"))
             .withColumn("n", F.least(F.lit(piece), F.col("mult") - F.col("nth") * piece).cast("int")))
    return dealt.groupBy("id", "part").agg(
        F.array_sort(F.flatten(F.collect_list(F.array_repeat("dst", F.col("n"))))).alias("edges"))


def links_to_adjacency_parts(links: DataFrame, part_links: int = 100_000, num_partitions: int | None = None) -> DataFrame:
    """G2 in ordered parts: ``(id, part, edges)``, where part p of a site holds the links
    from ``p * part_links`` on of its sorted list, so the parts end to end are the list.

    The links are first counted by target, then sorted by range, which cuts a hub's list
    over as many tasks as it fills.  The position of each piece is the sum of what
    lies before it: of a hub one number a task is summed, never its list.  No row
    and no group holds more than ``part_links`` links.
    """
    n = num_partitions or int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = links.groupBy(F.col("src").alias("id"), "dst").agg(F.count(F.lit(1)).alias("mult"))
    # stored, so that a pair keeps the task that its position counts from
    ranged = stored(pairs.repartitionByRange(n, "id", "dst").withColumn("task", F.spark_partition_id()))
    sums = ranged.groupBy("id", "task").agg(F.sum("mult").alias("held"))
    before = W.partitionBy("id").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("id", "task", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("id", "task").orderBy("dst").rowsBetween(W.unboundedPreceding, -1)
    placed = (ranged.withColumn("inside", F.coalesce(F.sum("mult").over(inside), F.lit(0))).join(offsets, ["id", "task"])
              .select("id", "dst", "mult", (F.col("offset") + F.col("inside")).alias("start")))
    size = F.lit(part_links).cast("bigint")

    def part_of(position):
        return F.call_function("div", position, size)

    last = F.col("start") + F.col("mult") - 1
    pieces = placed.select("id", "dst", "start", "mult", F.explode(F.sequence(part_of(F.col("start")), part_of(last))).alias("part"))
    count = F.least(F.col("start") + F.col("mult"), (F.col("part") + 1) * size) - F.greatest(F.col("start"), F.col("part") * size)
    return (pieces.select("id", "part", F.struct("dst", count.cast("int").alias("n")).alias("piece"))
            .groupBy("id", "part").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
            .select("id", "part", F.flatten(F.transform("pieces", lambda p: F.array_repeat(p["dst"], p["n"]))).alias("edges")))


def out_degree(sites: DataFrame) -> DataFrame:
    """G3 on the array form: number of out-links, parallel links counted."""
    return sites.select("id", F.size("edges").cast("bigint").alias("n_out"))


def out_degree_links(links: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """G3 on the link form; with ``nodes`` every node is reported, 0 when linkless."""
    deg = links.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n_out"))
    if nodes is None:
        return deg
    return (nodes.select("id").join(deg, "id", "left")
            .select("id", F.coalesce("n_out", F.lit(0)).cast("bigint").alias("n_out")))


# ---------------------------------------------------------------- one step, array form

def site_rank_join(sites: DataFrame, ranks: DataFrame) -> DataFrame:
    """Inner equi-join on id; unmatched rows on both sides drop."""
    return sites.join(ranks, "id", "inner").select("id", "edges", "rank")


def site_rank_join_parts(nodes: DataFrame, parts: DataFrame, ranks: DataFrame) -> DataFrame:
    """G4 on lists in parts: ``(id, part, edges, rank)``, each part beside its site's rank; a
    site without links has part 0 with an empty list.  Both joins move keys and parts,
    never a whole list, and AQE splits a hub's parts over tasks; a list is put
    together, if at all, by who reads the parts in order."""
    ranked = nodes.select("id").join(ranks.select("id", "rank"), "id")
    held = parts.join(ranked, "id").select("id", "part", "edges", "rank")
    empty = F.array().cast("array<bigint>")
    linkless = (ranked.join(parts.select("id").distinct(), "id", "left_anti")
                .select("id", F.lit(0).cast("bigint").alias("part"), empty.alias("edges"), "rank"))
    return held.unionByName(linkless)


def rank_contributions(joined: DataFrame) -> DataFrame:
    """Each site sends ``rank / n_out`` along every link.

    A linkless site explodes to no rows, so the division by zero is never
    evaluated for it (the size is guarded anyway).
    """
    n = F.size("edges")
    share = F.when(n > 0, F.col("rank") / n)
    return joined.select(F.explode("edges").alias("id"), share.alias("c"))


def rank_contributions_links(links: DataFrame, ranks: DataFrame) -> DataFrame:
    """G4 and G5 on the link form: the degree is an aggregate of the links, and
    each link takes its source's share, so no site's list is ever one row."""
    shares = (ranks.withColumnRenamed("id", "src").join(out_degree_links(links).withColumnRenamed("id", "src"), "src")
              .select("src", (F.col("rank") / F.col("n_out")).alias("c")))
    return links.select("src", "dst").join(shares, "src").select(F.col("dst").alias("id"), "c")


def contribution_sum(contribs: DataFrame) -> DataFrame:
    """Sum of contributions per target (partial + final aggregate)."""
    return contribs.groupBy("id").agg(F.sum("c").alias("x"))


def pagerank_step_links(links: DataFrame, ranks: DataFrame, keep_unlinked: bool = False) -> DataFrame:
    """G8 (``keep_unlinked`` False) or G9 on the link form: parallel links are
    combined map-side first, the degree is an aggregate of the links, and no
    site's list is ever one row."""
    edges = links.select("src", "dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"))
    deg = edges.groupBy("src").agg(F.sum("mult").alias("n_out"))
    shares = (ranks.withColumnRenamed("id", "src").join(deg, "src")
              .select("src", (F.col("rank") / F.col("n_out")).alias("share")))
    summed = (edges.join(shares, "src").groupBy(F.col("dst").alias("id"))
              .agg(F.sum(F.col("share") * F.col("mult")).alias("x")))
    if keep_unlinked:
        return (ranks.select("id").join(summed, "id", "left")
                .select("id", damp(F.coalesce("x", F.lit(0.0))).alias("rank")))
    return summed.select("id", damp("x").alias("rank"))


def pagerank_step(sites: DataFrame, ranks: DataFrame) -> DataFrame:
    """One update.  Only targets with at least one in-link from a ranked
    site appear in the result; a target absent from ``sites`` does appear."""
    return pagerank_step_links(adjacency_to_links(sites), ranks)


def pagerank_step_all_sites(sites: DataFrame, ranks: DataFrame) -> DataFrame:
    """Sequential variant; every id of ``ranks`` gets a rank, 0.15 when
    nothing links to it."""
    return pagerank_step_links(adjacency_to_links(sites), ranks, keep_unlinked=True)


# ---------------------------------------------------------------- checks on results

def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def rank_compare(a: DataFrame, b: DataFrame, tol: float = 1e-9) -> DataFrame:
    """One row ``(n_a, n_b, missing, max_delta, ok)``.

    ``missing`` counts ids present on one side only; ``ok`` holds when the
    counts agree, nothing is missing and every difference is below ``tol``.
    """
    j = (a.select("id", F.col("rank").alias("ra"))
         .join(b.select("id", F.col("rank").alias("rb")), "id", "full_outer"))
    out = j.agg(
        F.count("ra").alias("n_a"),
        F.count("rb").alias("n_b"),
        F.count_if(F.col("ra").isNull() | F.col("rb").isNull()).alias("missing"),
        F.max(F.abs(F.col("ra") - F.col("rb"))).alias("max_delta"))
    return out.select("*", ((F.col("n_a") == F.col("n_b")) & (F.col("missing") == 0)
                            & (F.coalesce("max_delta", F.lit(0.0)) < F.lit(tol))).alias("ok"))
