"""Registered queries: one Spark job per operator, over the driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal those of the matching SQL in ``trellis.oracle``.  PageRank, insert
classification, the products, the streams and the queries that need a
shape or a count run jobs while the DataFrame is built; the others are lazy.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.functions import paths as P
from trellis.functions.blocks import row_block
from trellis.functions.rank import damp
from trellis.functions.http import request_path
from trellis.operators import catalog as C
from trellis.operators import graph as G
from trellis.operators import requests as R
from trellis.operators import matrix as M
from trellis.operators import synth
from trellis.plans.matmul import matmul
from trellis.plans.pagerank import pagerank
from trellis.plans.tables import stored
from trellis.sources import views
from trellis.sources.tables import read_table
from trellis.session import shared_dir
from trellis.sources.catalog_log import CatalogTable
from trellis.sources.row_blocks import read_rows, write_row_blocks
from trellis.streaming.live import serve_arrivals
from trellis.streaming.serve import completed_arrivals, completed_available, serve_available


def _r9(c: str):
    return F.round(F.col(c), 9).alias(c)


# ------------------------------------------------------------------ graph inputs

def part_nodes(spark, sf):
    return read_table(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("id"))


def trade_nodes(spark, sf):
    cust = read_table(spark, sf, "customer", "c_custkey").select(F.col("c_custkey").alias("id"))
    supp = read_table(spark, sf, "supplier", "s_suppkey").select(
        (F.lit(views.SUPPLIER_ID_OFFSET) + F.col("s_suppkey")).alias("id"))
    return cust.unionByName(supp)


# whole lists: only for the two queries whose SQL returns them
def part_sites(spark, sf):
    return G.links_to_adjacency(part_nodes(spark, sf), views.part_links(spark, sf))


def trade_sites(spark, sf):
    return G.links_to_adjacency(trade_nodes(spark, sf), views.trade_links(spark, sf))


# ------------------------------------------------------------------ graph queries

def q_adjacency_to_links(spark, sf):
    return G.adjacency_to_links(G.links_to_adjacency_chunks(views.part_links(spark, sf)))


def q_links_to_adjacency(spark, sf):
    return part_sites(spark, sf)


def q_out_degree(spark, sf):
    return G.out_degree_links(views.part_links(spark, sf), part_nodes(spark, sf))


def q_site_rank_join(spark, sf):
    cust = read_table(spark, sf, "customer", "c_custkey").select(F.col("c_custkey").alias("id"))
    return G.site_rank_join(trade_sites(spark, sf), synth.initial_ranks(cust))


def q_site_rank_join_parts(spark, sf):
    """Lists in parts of 20 links, so that most sites have several."""
    cust = read_table(spark, sf, "customer", "c_custkey").select(F.col("c_custkey").alias("id"))
    parts = G.links_to_adjacency_parts(views.trade_links(spark, sf), 20)
    return G.site_rank_join_parts(trade_nodes(spark, sf), parts, synth.initial_ranks(cust))


def q_rank_contributions(spark, sf):
    out = G.rank_contributions_links(views.part_links(spark, sf), synth.initial_ranks(part_nodes(spark, sf)))
    return out.select("id", _r9("c"))


def q_contribution_sum(spark, sf):
    out = G.rank_contributions_links(views.part_links(spark, sf), synth.initial_ranks(part_nodes(spark, sf)))
    return G.contribution_sum(out).select("id", _r9("x"))


def q_damp(spark, sf):
    r0 = synth.initial_ranks(part_nodes(spark, sf))
    return r0.select("id", F.round(damp("rank"), 9).alias("rank"))


def q_pagerank_step(spark, sf):
    out = G.pagerank_step_links(views.trade_links(spark, sf), synth.initial_ranks(trade_nodes(spark, sf)))
    return out.select("id", _r9("rank"))


def q_pagerank_step_all_sites(spark, sf):
    out = G.pagerank_step_links(views.trade_links(spark, sf), synth.initial_ranks(trade_nodes(spark, sf)),
                                keep_unlinked=True)
    return out.select("id", _r9("rank"))


def q_pagerank(spark, sf):
    out = pagerank(views.part_links(spark, sf), synth.initial_ranks(part_nodes(spark, sf)), 5)
    return out.select("id", _r9("rank"))


def q_pagerank_trade(spark, sf):
    out = pagerank(views.trade_ring(spark, sf), synth.initial_ranks(trade_nodes(spark, sf)), 5)
    return out.select("id", _r9("rank"))


def q_pagerank_all_sites(spark, sf):
    out = pagerank(views.trade_links(spark, sf), synth.initial_ranks(trade_nodes(spark, sf)), 5,
                   keep_unlinked=True)
    return out.select("id", _r9("rank"))


def q_rank_compare(spark, sf):
    links = views.part_links(spark, sf)
    r0 = synth.initial_ranks(part_nodes(spark, sf))
    a = pagerank(links, r0, 4)
    b = pagerank(links, r0, 5)
    return G.rank_compare(a, b).select("n_a", "n_b", "missing", _r9("max_delta"), "ok")


def q_duplicate_keys(spark, sf):
    return G.duplicate_keys(read_table(spark, sf, "lineitem", "l_orderkey"), "l_orderkey")


def q_initial_ranks(spark, sf):
    return synth.initial_ranks(part_nodes(spark, sf))


def _q_synth_links(dist):
    def q(spark, sf):
        nodes = part_nodes(spark, sf)
        return synth.synth_links(nodes, nodes.count(), 20, 40, dist)
    q.__name__ = f"q_synth_links_{dist}"
    return q


GRAPH = {
    "adjacency_to_links": q_adjacency_to_links,
    "links_to_adjacency": q_links_to_adjacency,
    "out_degree": q_out_degree,
    "site_rank_join": q_site_rank_join,
    "site_rank_join_parts": q_site_rank_join_parts,
    "rank_contributions": q_rank_contributions,
    "contribution_sum": q_contribution_sum,
    "damp": q_damp,
    "pagerank_step": q_pagerank_step,
    "pagerank_step_all_sites": q_pagerank_step_all_sites,
    "pagerank": q_pagerank,
    "pagerank_trade": q_pagerank_trade,
    "pagerank_all_sites": q_pagerank_all_sites,
    "rank_compare": q_rank_compare,
    "duplicate_keys": q_duplicate_keys,
    "initial_ranks": q_initial_ranks,
    "synth_links_uniform": _q_synth_links("uniform"),
    "synth_links_increasing": _q_synth_links("increasing"),
    "synth_links_random": _q_synth_links("random"),
}


# ------------------------------------------------------------------ matrix

def supply_cells(spark, sf):
    return views.supply(spark, sf).select("i", F.col("k").alias("j"), "v")


def returned_lines(spark, sf):
    li = read_table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_quantity", "l_returnflag")
    return li.where(F.col("l_returnflag") == "R")


def q_matrix_from_flat(spark, sf):
    e = read_table(spark, sf, "embeddings", "vec_id", "embedding")
    return M.matrix_from_flat(e, "embedding", 8, keys=("vec_id",))


def q_matrix_to_rows(spark, sf):
    e = views.emb(spark, sf).select("i", F.col("k").alias("j"), "v")
    return M.matrix_to_rows(e, M.shape_of(e)[1])


def q_matrix_shape(spark, sf):
    return M.matrix_shape(supply_cells(spark, sf))


def q_matrix_get(spark, sf):
    li = read_table(spark, sf, "lineitem", "l_suppkey", "l_partkey")
    wanted = li.select(F.col("l_suppkey").alias("i"), (F.col("l_partkey") + 1).alias("j")).distinct()
    return M.matrix_get(supply_cells(spark, sf), wanted)


def _updates(spark, sf):
    return (returned_lines(spark, sf)
            .groupBy(F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j"))
            .agg(F.max("l_quantity").alias("v")))


def q_matrix_set(spark, sf):
    return M.matrix_set(supply_cells(spark, sf), _updates(spark, sf))


def q_matrix_incr(spark, sf):
    deltas = returned_lines(spark, sf).select(
        F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j"), F.col("l_quantity").alias("v"))
    return M.matrix_incr(supply_cells(spark, sf), deltas)


def q_densify(spark, sf):
    m = views.emb_positive(spark, sf)
    nrows, ncols = M.shape_of(m)
    return M.densify(m, nrows, ncols)


def q_matmul_cells(spark, sf):
    s = supply_cells(spark, sf)
    return M.matmul_cells(s, M.transpose(s))


def line_cells(spark, sf):
    """(supplier, line number) quantities: as many k as an order has lines, all of them hot."""
    li = read_table(spark, sf, "lineitem", "l_suppkey", "l_linenumber", "l_quantity")
    return li.groupBy(F.col("l_suppkey").alias("i"), F.col("l_linenumber").cast("bigint").alias("j")).agg(F.sum("l_quantity").alias("v"))


def q_matmul_hot_k(spark, sf):
    m = line_cells(spark, sf)
    return M.matmul_cells_spread(m, M.transpose(m))


def q_matmul_dense(spark, sf):
    e = views.emb_positive(spark, sf)
    g = views.emb_gram(spark, sf)
    out = M.matmul_dense(e, g, M.shape_of(e), M.shape_of(g))
    return out.select("i", "j", F.round("v", 6).alias("v"))


def q_matmul_blocked(spark, sf):
    s = supply_cells(spark, sf)
    return M.matmul_blocked(s, M.transpose(s))


def q_matmul(spark, sf):
    s = supply_cells(spark, sf)
    return matmul(s, M.transpose(s))


def q_matmul_broadcast(spark, sf):
    e = views.emb(spark, sf).select("i", F.col("k").alias("j"), "v")
    gram = stored(views.emb_gram(spark, sf))
    out = M.matmul_broadcast(e, gram, M.shape_of(gram))
    return out.select("i", "j", F.round("v", 6).alias("v"))


def q_row_blocks(spark, sf):
    nrows = read_table(spark, sf, "part", "p_partkey").count()
    ncols = read_table(spark, sf, "supplier", "s_suppkey").count()
    parts = [M.row_blocks(spark, nrows, ncols, size).select(F.lit(size).cast("bigint").alias("size"), "*")
             for size in (1, 7, nrows + 3)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_row_block_assign(spark, sf):
    part = read_table(spark, sf, "part", "p_partkey")
    nrows = part.count()
    return part.select(F.col("p_partkey").alias("i"), row_block("p_partkey", nrows, 7).alias("block"))


def q_gather_blocks(spark, sf):
    return M.gather_blocks(supply_cells(spark, sf))


def q_read_row_range(spark, sf):
    """The middle third of the rows, from files in seven row blocks."""
    s = stored(supply_cells(spark, sf))
    nrows, ncols = M.shape_of(s)
    path = shared_dir(spark, "row-blocks")
    write_row_blocks(s, path, nrows, ncols, 7)
    return read_rows(spark, path, nrows // 3, 2 * nrows // 3)


def q_matrix_diff(spark, sf):
    s = supply_cells(spark, sf)
    return M.matrix_diff(s, M.matrix_set(s, _updates(spark, sf)))


def q_synth_matrix(spark, sf):
    return synth.synth_values(supply_cells(spark, sf).select("i", "j"))


MATRIX = {
    "matrix_from_flat": q_matrix_from_flat,
    "matrix_to_rows": q_matrix_to_rows,
    "matrix_shape": q_matrix_shape,
    "matrix_get": q_matrix_get,
    "matrix_set": q_matrix_set,
    "matrix_incr": q_matrix_incr,
    "densify": q_densify,
    "matmul_cells": q_matmul_cells,
    "matmul_hot_k": q_matmul_hot_k,
    "matmul_dense": q_matmul_dense,
    "matmul_blocked": q_matmul_blocked,
    "matmul": q_matmul,
    "matmul_broadcast": q_matmul_broadcast,
    "row_blocks": q_row_blocks,
    "row_block_assign": q_row_block_assign,
    "gather_blocks": q_gather_blocks,
    "read_row_range": q_read_row_range,
    "matrix_diff": q_matrix_diff,
    "synth_matrix": q_synth_matrix,
}


# ------------------------------------------------------------------ catalog

def request_paths(spark, sf):
    """Every request with the path its line names (NULL when none)."""
    return views.requests(spark, sf).select("request_id", request_path("line").alias("path"))


def q_path_components(spark, sf):
    return request_paths(spark, sf).select("request_id", "path", P.path_components("path").alias("comps"))


def q_path_canonical(spark, sf):
    rp = request_paths(spark, sf)
    return rp.select("request_id", P.path_canonical(P.path_components("path")).alias("canonical"))


def q_is_absolute(spark, sf):
    return request_paths(spark, sf).select("request_id", P.is_absolute("path").alias("absolute"))


def q_path_part_depth(spark, sf):
    c = P.path_components("path")
    return request_paths(spark, sf).select(
        "request_id", P.path_part(c, 0).alias("part0"), P.path_part(c, 2).alias("part2"),
        P.path_depth(c).cast("bigint").alias("depth"))


def q_under_root(spark, sf):
    return request_paths(spark, sf).select(
        "request_id", P.under_root(P.path_components("path")).alias("under_root"))


def q_folder_tree(spark, sf):
    return C.folder_tree(views.files(spark, sf)).select("folder", F.col("depth").cast("bigint"))


def q_list_children(spark, sf):
    return C.list_children(views.files(spark, sf))


def q_has_child(spark, sf):
    keys = request_paths(spark, sf).select("request_id", P.path_key("path").alias("key"))
    probe = (keys.where(P.key_depth("key") >= 1)
             .select("request_id", P.key_parent("key").alias("parent"), P.key_name("key").alias("name")))
    out = C.has_child(C.list_children(views.files(spark, sf)), probe.select("parent", "name"))
    return out


def q_read_files(spark, sf):
    return C.read_files(views.files(spark, sf), request_paths(spark, sf))


def q_path_kind(spark, sf):
    return C.path_kind(views.files(spark, sf), request_paths(spark, sf))


def insert_batch(spark, sf):
    """Every file and every request path (contents = its line), interleaved: files
    have even numbers, requests odd ones, so they never meet at any scale."""
    docs = views.document_files(spark, sf).withColumn("seq", 2 * F.col("doc_id"))
    reqs = views.requests(spark, sf).select(
        (2 * F.col("request_id") + 1).alias("seq"), request_path("line").alias("path"),
        F.col("line").alias("contents"))
    return docs.select("seq", "path", "contents").unionByName(reqs)


def english_catalog(spark, sf):
    docs = views.document_files(spark, sf)
    return docs.where(F.col("lang") == "en").select("path", "contents")


def q_add_files(spark, sf):
    v = C.classify_inserts(english_catalog(spark, sf), insert_batch(spark, sf))
    return v.select("seq", "path", "verdict")


def q_add_files_accepted(spark, sf):
    accepted, _ = C.add_files(english_catalog(spark, sf), insert_batch(spark, sf))
    return accepted


def q_insert_files(spark, sf):
    """Three commits and a repeated one; the table's rows and dead letters."""
    table = CatalogTable(spark, shared_dir(spark, "insert-files"))
    docs = views.document_files(spark, sf).withColumn("seq", F.col("doc_id"))
    reqs = views.requests(spark, sf).select(F.col("request_id").alias("seq"), request_path("line").alias("path"),
                                            F.col("line").alias("contents"))
    table.insert(docs.where(F.col("lang") == "en"), "english")
    table.insert(reqs, "requests")
    table.insert(docs, "documents")
    table.insert(reqs, "requests")
    dead = [table.rejected(b).select(F.lit(b).alias("batch"), "seq", "path", "reason") for b in ("english", "requests", "documents")]
    kept = table.files().select(F.lit("kept").alias("batch"), F.lit(None).cast("bigint").alias("seq"), "path", F.col("contents").alias("reason"))
    return kept.unionByName(dead[0]).unionByName(dead[1]).unionByName(dead[2])


def q_add_files_rejected(spark, sf):
    _, rejected = C.add_files(english_catalog(spark, sf), insert_batch(spark, sf))
    return rejected


# ------------------------------------------------------------------ requests

def q_parse_requests(spark, sf):
    return R.parse_requests(views.requests(spark, sf)).select("request_id", "line", "method_ok", "path")


def q_reject_requests(spark, sf):
    return R.reject_requests(R.parse_requests(views.requests(spark, sf)))


def q_serve(spark, sf):
    return R.serve(views.requests(spark, sf), views.files(spark, sf)).select(
        "request_id", "path", "status", "body")


def q_format_response(spark, sf):
    return R.responses(R.serve(views.requests(spark, sf), views.files(spark, sf)))


def q_completed_requests(spark, sf):
    return R.completed_requests(R.serve(views.requests(spark, sf), views.files(spark, sf)))


def q_response_check(spark, sf):
    req = views.requests(spark, sf)
    files = views.files(spark, sf)
    # served from the English files only, so requests for the others differ
    got = R.serve(req, english_catalog(spark, sf))
    # expected, computed another way: strip trailing slashes and compare path strings
    ok = R.accepted_requests(R.parse_requests(req)).select(
        "request_id", F.regexp_replace("path", "/+$", "").alias("p"))
    exp = (ok.join(files.select(F.col("path").alias("p"), "contents"), "p", "left")
           .select("request_id", F.when(F.col("contents").isNull(), 404).otherwise(200).alias("status"),
                   F.col("contents").alias("body")))
    return R.response_check(got, exp)


def q_serve_stream(spark, sf):
    return serve_available(spark, sf).select("request_id", "path", "status", "body")


def q_completed_requests_stream(spark, sf):
    return completed_available(spark, sf, lateness="1 hour")


def q_completed_requests_late(spark, sf):
    return completed_arrivals(spark, sf, "5 days")


def q_serve_live(spark, sf):
    return serve_arrivals(spark, sf).select("request_id", "path", "status", "body")


CATALOG = {
    "path_components": q_path_components,
    "path_canonical": q_path_canonical,
    "is_absolute": q_is_absolute,
    "path_part_depth": q_path_part_depth,
    "under_root": q_under_root,
    "folder_tree": q_folder_tree,
    "list_children": q_list_children,
    "has_child": q_has_child,
    "read_files": q_read_files,
    "path_kind": q_path_kind,
    "add_files": q_add_files,
    "add_files_accepted": q_add_files_accepted,
    "add_files_rejected": q_add_files_rejected,
    "insert_files": q_insert_files,
}

REQUESTS = {
    "parse_requests": q_parse_requests,
    "reject_requests": q_reject_requests,
    "serve": q_serve,
    "format_response": q_format_response,
    "completed_requests": q_completed_requests,
    "response_check": q_response_check,
    "serve_stream": q_serve_stream,
    "serve_live": q_serve_live,
    "completed_requests_stream": q_completed_requests_stream,
    "completed_requests_late": q_completed_requests_late,
}


def all_queries() -> dict:
    out = {}
    out.update(GRAPH)
    out.update(MATRIX)
    out.update(CATALOG)
    out.update(REQUESTS)
    return out
