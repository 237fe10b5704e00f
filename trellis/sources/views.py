"""Derived inputs built from the driver tables.

Each view is a lazily evaluated DataFrame over the parquet tables, so its
size grows with the scale factor and Catalyst can prune and push down
through it.  The same views are written in SQL in ``trellis.oracle`` for the
DuckDB comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trellis.plans.sizing import spread
from trellis.sources.tables import read_table

# Supplier ids are shifted by this offset in ``trade_links`` so
# they never collide with customer ids.
SUPPLIER_ID_OFFSET = 1000000000


def part_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst): each part links to the next part of the same order."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return (li.select(F.col("l_partkey").alias("src"),
                      F.lead("l_partkey").over(w).alias("dst"))
            .where(F.col("dst").isNotNull()))


def trade_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst): customer -> supplier (offset), one link per line item."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
    return (o.join(li, o.o_orderkey == li.l_orderkey)
            .select(F.col("o_custkey").alias("src"),
                    (F.lit(SUPPLIER_ID_OFFSET) + F.col("l_suppkey")).alias("dst")))


def trade_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst): ``trade_links`` in both directions, so every site that links
    is linked to."""
    out = trade_links(spark, sf_dir)
    return out.unionByName(out.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(i, k, v): sparse supplier x part matrix of summed quantities."""
    li = read_table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_quantity")
    return (li.groupBy(F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("k"))
            .agg(F.sum("l_quantity").alias("v")))


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, path, contents): every document as a doubly nested file."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    did = F.col("doc_id")
    path = F.concat(F.lit("/static/d"), (did % 4).cast("string"),
                    F.lit("/e"), (did % 20).cast("string"),
                    F.lit("/"), did.cast("string"), F.lit(".txt"))
    return d.select("doc_id", "lang", path.alias("path"), F.col("text").alias("contents"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, contents): every document as a doubly nested file."""
    return document_files(spark, sf_dir).select("path", "contents")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, ts, driver, line): request lines with hits, misses and odd cases."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    return request_lines(ev)


#: Parts in which ``arrivals`` deals out the events: three in order, and what the
#: third brings too late.
ARRIVALS = 4


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``arrival``: the third of the ids that an event lies in, one later
    for every seventh id."""
    ev = read_table(spark, sf_dir, "events")
    last = ev.agg(F.max("event_id").alias("m")).first()["m"] or 0
    third = F.call_function("div", F.col("event_id") * 3, F.lit(last + 1).cast("bigint"))
    return ev.withColumn("arrival", third + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0))


def request_lines(events: DataFrame) -> DataFrame:
    """Turn event rows into request lines; stateless, so it also runs on a stream."""
    n = F.call_function("div", F.col("event_id").cast("bigint"), F.lit(4).cast("bigint"))
    d = n.cast("string")
    d4 = (n % 4).cast("string")
    d20 = (n % 20).cast("string")
    p = F.concat(F.lit("/static/d"), d4, F.lit("/e"), d20, F.lit("/"), d, F.lit(".txt"))
    case = F.col("event_id") % 10
    line = (F.when(case == 0, F.concat(F.lit("GET /static/d"), d4, F.lit(" HTTP/1.1")))
            .when(case == 1, F.concat(F.lit("GET "), p, F.lit("/ HTTP/1.1")))
            .when(case == 2, F.concat(F.lit("GET /static//"), d, F.lit(".txt HTTP/1.1")))
            .when(case == 3, F.concat(F.lit("GET /other/"), d, F.lit(".txt HTTP/1.1")))
            .when(case == 4, F.concat(F.lit("GET "), p, F.lit("/x.txt HTTP/1.1")))
            .when(case == 5, F.concat(F.lit("POST "), p, F.lit(" HTTP/1.1")))
            .when(case == 6, F.lit("GET"))
            .otherwise(F.concat(F.lit("GET "), p, F.lit(" HTTP/1.1"))))
    return events.select(F.col("event_id").alias("request_id"), "ts",
                         F.col("user_id").alias("driver"), line.alias("line"))


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(i, k, v): embeddings as a dense matrix in cell form, positions from 0."""
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return e.select(F.col("vec_id").alias("i"),
                    F.posexplode("embedding").alias("k", "v")).select(
        "i", F.col("k").cast("bigint").alias("k"), F.col("v").cast("double").alias("v"))


def emb_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(i, j, v): the positive embedding cells, a sparse matrix of bounded width."""
    return emb(spark, sf_dir).where("v > 0").select("i", F.col("k").alias("j"), "v")


def emb_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(i, j, v): the embeddings' Gram matrix over all rows (width x width)."""
    e = spread(read_table(spark, sf_dir, "embeddings", "embedding"))
    cells = e.select(F.posexplode("embedding").alias("i", "a"), "embedding").select(
        "i", "a", F.posexplode("embedding").alias("j", "b"))
    return (cells.groupBy(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"))
            .agg(F.sum(F.col("a").cast("double") * F.col("b").cast("double")).alias("v")))
