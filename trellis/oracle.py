"""DuckDB SQL for every registered query: the correctness oracle.

Each entry is self-contained text over the driver's pre-registered table
views.  Floats that depend on summation order are rounded to 9 places on
both sides (``round9``); integer-valued results are compared exactly.
"""

from __future__ import annotations

from trellis.functions.hashing import mix_sql

# ------------------------------------------------------------------ views

PART_LINKS = """part_links AS (
  SELECT src, dst FROM (
    SELECT l_partkey AS src,
           lead(l_partkey) OVER (PARTITION BY l_orderkey
                                 ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst
    FROM lineitem) t
  WHERE dst IS NOT NULL)"""

TRADE_LINKS = """trade_links AS (
  SELECT o_custkey AS src, 1000000000 + l_suppkey AS dst
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"""

TRADE_RING = """trade_ring AS (
  SELECT src, dst FROM trade_links UNION ALL SELECT dst, src FROM trade_links)"""
RING_DEG = """ring_deg AS (SELECT src, count(*) AS n_out FROM trade_ring GROUP BY src)"""

TRADE_NODES = """trade_nodes AS (
  SELECT c_custkey AS id FROM customer
  UNION ALL SELECT 1000000000 + s_suppkey AS id FROM supplier)"""

SUPPLY = """supply AS (
  SELECT l_suppkey AS i, l_partkey AS k, CAST(sum(l_quantity) AS DOUBLE) AS v
  FROM lineitem GROUP BY l_suppkey, l_partkey)"""

FILES = """files AS (
  SELECT '/static/d' || CAST(doc_id % 4 AS VARCHAR) || '/e' || CAST(doc_id % 20 AS VARCHAR)
         || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, text AS contents
  FROM documents)"""

REQUESTS = """requests AS (
  SELECT event_id AS request_id, ts, user_id AS driver,
    CASE event_id % 10
      WHEN 0 THEN 'GET /static/d' || d4 || ' HTTP/1.1'
      WHEN 1 THEN 'GET ' || p || '/ HTTP/1.1'
      WHEN 2 THEN 'GET /static//' || d || '.txt HTTP/1.1'
      WHEN 3 THEN 'GET /other/' || d || '.txt HTTP/1.1'
      WHEN 4 THEN 'GET ' || p || '/x.txt HTTP/1.1'
      WHEN 5 THEN 'POST ' || p || ' HTTP/1.1'
      WHEN 6 THEN 'GET'
      ELSE 'GET ' || p || ' HTTP/1.1' END AS line
  FROM (SELECT *, '/static/d' || d4 || '/e' || d20 || '/' || d || '.txt' AS p
        FROM (SELECT event_id, ts, user_id,
                     CAST(n AS VARCHAR) AS d, CAST(n % 4 AS VARCHAR) AS d4,
                     CAST(n % 20 AS VARCHAR) AS d20
              FROM (SELECT event_id, ts, user_id,
                           CAST(floor(event_id / 4) AS BIGINT) AS n FROM events) a) b) c)"""

EMB = """emb AS (
  SELECT vec_id AS i, CAST(pos - 1 AS BIGINT) AS k, CAST(embedding[pos] AS DOUBLE) AS v
  FROM (SELECT vec_id, embedding, generate_subscripts(embedding, 1) AS pos FROM embeddings) e)"""


EMB_POS = "pos AS (SELECT i, k, v FROM emb WHERE v > 0)"
GRAM = """gram AS (
  SELECT a.k AS i, b.k AS j, sum(a.v * b.v) AS v FROM emb a JOIN emb b ON a.i = b.i GROUP BY a.k, b.k)"""


def start_rank_sql(id_col: str, seed: int = 42) -> str:
    return f"CAST(({mix_sql(id_col, '0', str(seed))}) % 1000000 AS DOUBLE) / 10000.0"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------ graph

PART_SITES = """part_sites AS (
  SELECT p_partkey AS id, coalesce(e.edges, []::BIGINT[]) AS edges
  FROM part LEFT JOIN (SELECT src, list_sort(list(dst)) AS edges FROM part_links GROUP BY src) e
       ON e.src = p_partkey)"""

PART_DEG = """part_deg AS (SELECT src, count(*) AS n_out FROM part_links GROUP BY src)"""
TRADE_DEG = """trade_deg AS (SELECT src, count(*) AS n_out FROM trade_links GROUP BY src)"""
PART_R0 = f"""part_r0 AS (SELECT p_partkey AS id, {start_rank_sql('p_partkey')} AS rank FROM part)"""
TRADE_R0 = f"""trade_r0 AS (SELECT id, {start_rank_sql('id')} AS rank FROM trade_nodes)"""


def _step_cte(name: str, prev: str, links: str, deg: str, keep_unlinked: bool = False) -> str:
    summed = (f"SELECT l.dst AS id, sum(r.rank / d.n_out) AS x FROM {links} l "
              f"JOIN {deg} d ON d.src = l.src JOIN {prev} r ON r.id = l.src GROUP BY l.dst")
    if keep_unlinked:
        return (f"{name} AS (SELECT p.id, 0.15 + 0.85 * coalesce(s.x, 0.0) AS rank "
                f"FROM {prev} p LEFT JOIN ({summed}) s ON s.id = p.id)")
    return f"{name} AS (SELECT id, 0.15 + 0.85 * x AS rank FROM ({summed}) s)"


def _pagerank_sql(links_cte: str, links: str, deg_cte: str, deg: str, r0_cte: str, r0: str,
                  iterations: int, keep_unlinked: bool = False, extra: tuple = ()) -> tuple:
    ctes = [*extra, links_cte, deg_cte, r0_cte]
    prev = r0
    for it in range(1, iterations + 1):
        name = f"r{it}_"
        ctes.append(_step_cte(name, prev, links, deg, keep_unlinked))
        prev = name
    return ctes, prev


def graph_sql() -> dict:
    q = {}
    q["adjacency_to_links"] = _with(PART_LINKS) + "SELECT src, dst FROM part_links"
    q["links_to_adjacency"] = _with(PART_LINKS, PART_SITES) + "SELECT id, edges FROM part_sites"
    q["out_degree"] = _with(PART_LINKS, PART_DEG) + (
        "SELECT p_partkey AS id, CAST(coalesce(d.n_out, 0) AS BIGINT) AS n_out "
        "FROM part LEFT JOIN part_deg d ON d.src = p_partkey")
    q["site_rank_join"] = _with(TRADE_LINKS, TRADE_NODES) + f"""
        SELECT n.id, coalesce(e.edges, []::BIGINT[]) AS edges, {start_rank_sql('c_custkey')} AS rank
        FROM trade_nodes n
        JOIN customer ON c_custkey = n.id
        LEFT JOIN (SELECT src, list_sort(list(dst)) AS edges FROM trade_links GROUP BY src) e
             ON e.src = n.id"""
    q["site_rank_join_parts"] = _with(TRADE_LINKS, TRADE_NODES) + f""",
        lists AS (SELECT src, list_sort(list(dst)) AS edges FROM trade_links GROUP BY src),
        sites AS (SELECT n.id, coalesce(e.edges, []::BIGINT[]) AS edges, {start_rank_sql('c_custkey')} AS rank
                  FROM trade_nodes n JOIN customer ON c_custkey = n.id LEFT JOIN lists e ON e.src = n.id)
        SELECT id, CAST(p AS BIGINT) AS part, edges[20 * p + 1:20 * p + 20] AS edges, rank
        FROM (SELECT *, unnest(range(greatest(1, (len(edges) + 19) // 20))) AS p FROM sites) t"""
    q["rank_contributions"] = _with(PART_LINKS, PART_DEG, PART_R0) + """
        SELECT l.dst AS id, round(r.rank / d.n_out, 9) AS c
        FROM part_links l JOIN part_deg d ON d.src = l.src JOIN part_r0 r ON r.id = l.src"""
    q["contribution_sum"] = _with(PART_LINKS, PART_DEG, PART_R0) + """
        SELECT l.dst AS id, round(sum(r.rank / d.n_out), 9) AS x
        FROM part_links l JOIN part_deg d ON d.src = l.src JOIN part_r0 r ON r.id = l.src
        GROUP BY l.dst"""
    q["damp"] = _with(PART_R0) + "SELECT id, round(0.15 + 0.85 * rank, 9) AS rank FROM part_r0"
    q["pagerank_step"] = _with(TRADE_LINKS, TRADE_NODES, TRADE_DEG, TRADE_R0) + """
        SELECT l.dst AS id, round(0.15 + 0.85 * sum(r.rank / d.n_out), 9) AS rank
        FROM trade_links l JOIN trade_deg d ON d.src = l.src JOIN trade_r0 r ON r.id = l.src
        GROUP BY l.dst"""
    q["pagerank_step_all_sites"] = _with(TRADE_LINKS, TRADE_NODES, TRADE_DEG, TRADE_R0) + """
        SELECT p.id, round(0.15 + 0.85 * coalesce(s.x, 0.0), 9) AS rank
        FROM trade_r0 p LEFT JOIN (
          SELECT l.dst AS id, sum(r.rank / d.n_out) AS x
          FROM trade_links l JOIN trade_deg d ON d.src = l.src JOIN trade_r0 r ON r.id = l.src
          GROUP BY l.dst) s ON s.id = p.id"""
    ctes, last = _pagerank_sql(PART_LINKS, "part_links", PART_DEG, "part_deg", PART_R0, "part_r0", 5)
    q["pagerank"] = _with(*ctes) + f"SELECT id, round(rank, 9) AS rank FROM {last}"
    ctes, last = _pagerank_sql(TRADE_RING, "trade_ring", RING_DEG, "ring_deg", TRADE_R0,
                               "trade_r0", 5, extra=(TRADE_NODES, TRADE_LINKS))
    q["pagerank_trade"] = _with(*ctes) + f"SELECT id, round(rank, 9) AS rank FROM {last}"
    ctes, last = _pagerank_sql(TRADE_LINKS, "trade_links", TRADE_DEG, "trade_deg", TRADE_R0,
                               "trade_r0", 5, keep_unlinked=True, extra=(TRADE_NODES,))
    q["pagerank_all_sites"] = _with(*ctes) + f"SELECT id, round(rank, 9) AS rank FROM {last}"
    ctes4, last4 = _pagerank_sql(PART_LINKS, "part_links", PART_DEG, "part_deg", PART_R0, "part_r0", 4)
    ctes5 = ctes4 + [_step_cte("r5_", last4, "part_links", "part_deg")]
    q["rank_compare"] = _with(*ctes5) + f"""
        SELECT count(a.rank) AS n_a, count(b.rank) AS n_b,
               CAST(count(*) FILTER (WHERE a.rank IS NULL OR b.rank IS NULL) AS BIGINT) AS missing,
               round(max(abs(a.rank - b.rank)), 9) AS max_delta,
               (count(a.rank) = count(b.rank)
                AND count(*) FILTER (WHERE a.rank IS NULL OR b.rank IS NULL) = 0
                AND coalesce(max(abs(a.rank - b.rank)), 0.0) < 1e-9) AS ok
        FROM {last4} a FULL OUTER JOIN r5_ b ON a.id = b.id"""
    q["duplicate_keys"] = ("SELECT l_orderkey, count(*) AS n FROM lineitem "
                           "GROUP BY l_orderkey HAVING count(*) > 1")
    q["initial_ranks"] = f"SELECT p_partkey AS id, {start_rank_sql('p_partkey')} AS rank FROM part"
    for dist in ("uniform", "increasing", "random"):
        q[f"synth_links_{dist}"] = _synth_links_sql(dist)
    return q


def _synth_links_sql(dist: str, lo: int = 20, hi: int = 40, seed: int = 42) -> str:
    if dist == "uniform":
        n_out = str(hi)
    elif dist == "increasing":
        n_out = (f"{lo} + CAST(trunc(CAST({hi - lo} AS DOUBLE) * "
                 f"(CAST(p_partkey AS DOUBLE) / CAST(n AS DOUBLE))) AS INTEGER)")
    else:
        n_out = f"{lo} + ({mix_sql('p_partkey', '0', str(seed + 1))}) % {hi - lo}"
    return f"""
        WITH cnt AS (SELECT count(*) AS n FROM part),
        deg AS (SELECT p_partkey, n, {n_out} AS n_out FROM part, cnt)
        SELECT p_partkey AS src, ({mix_sql('p_partkey', 'j + 1', str(seed))}) % n AS dst
        FROM (SELECT p_partkey, n, unnest(range(0, n_out)) AS j FROM deg) t"""


# ------------------------------------------------------------------ matrix

SUPPLY_T = """supply_t AS (SELECT k AS i, i AS j, v FROM supply)"""
UPDATES = """updates AS (
  SELECT l_suppkey AS i, l_partkey AS j, max(l_quantity) AS v
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey, l_partkey)"""
SET_SUPPLY = """set_supply AS (
  SELECT i, k AS j, v FROM supply s
  WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.i = s.i AND u.j = s.k)
  UNION ALL SELECT i, j, v FROM updates)"""
PRODUCT = """product AS (
  SELECT a.i, b.j, sum(a.v * b.v) AS v FROM supply a JOIN supply_t b ON a.k = b.i
  GROUP BY a.i, b.j)"""


def matrix_sql() -> dict:
    q = {}
    q["matrix_from_flat"] = """
        SELECT vec_id, CAST((pos - 1) // 8 AS BIGINT) AS i, CAST((pos - 1) % 8 AS BIGINT) AS j,
               CAST(embedding[pos] AS DOUBLE) AS v
        FROM (SELECT vec_id, embedding, generate_subscripts(embedding, 1) AS pos FROM embeddings) e"""
    q["matrix_to_rows"] = """
        WITH w AS (SELECT max(len(embedding)) AS n FROM embeddings)
        SELECT vec_id AS i, vec_id * n AS row_offset, CAST(embedding AS DOUBLE[]) AS row
        FROM embeddings, w"""
    q["matrix_shape"] = _with(SUPPLY) + (
        "SELECT max(i) + 1 AS nrows, max(k) + 1 AS ncols FROM supply")
    q["matrix_get"] = _with(SUPPLY) + """
        SELECT w.i, w.j, coalesce(s.v, 0.0) AS v
        FROM (SELECT DISTINCT l_suppkey AS i, l_partkey + 1 AS j FROM lineitem) w
        LEFT JOIN supply s ON s.i = w.i AND s.k = w.j"""
    q["matrix_set"] = _with(SUPPLY, UPDATES, SET_SUPPLY) + "SELECT i, j, v FROM set_supply"
    q["matrix_incr"] = _with(SUPPLY) + """
        SELECT i, j, sum(v) AS v FROM (
          SELECT i, k AS j, v FROM supply
          UNION ALL SELECT l_suppkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R') t
        GROUP BY i, j"""
    q["densify"] = _with(EMB, EMB_POS) + """,
        shape AS (SELECT max(i) + 1 AS nr, max(k) + 1 AS nc FROM pos),
        grid AS (SELECT r // nc AS i, r % nc AS j FROM shape, range(0, nr * nc) t(r))
        SELECT g.i, g.j, coalesce(s.v, 0.0) AS v FROM grid g LEFT JOIN pos s ON s.i = g.i AND s.k = g.j"""
    q["matmul_cells"] = _with(SUPPLY, SUPPLY_T, PRODUCT) + "SELECT i, j, v FROM product"
    q["matmul_blocked"] = q["matmul_cells"]
    q["matmul"] = q["matmul_cells"]
    q["matmul_hot_k"] = """
        WITH m AS (SELECT l_suppkey AS i, CAST(l_linenumber AS BIGINT) AS k, CAST(sum(l_quantity) AS DOUBLE) AS v
                   FROM lineitem GROUP BY l_suppkey, l_linenumber)
        SELECT a.i, b.i AS j, sum(a.v * b.v) AS v FROM m a JOIN m b ON a.k = b.k GROUP BY a.i, b.i"""
    q["read_row_range"] = _with(SUPPLY) + """,
        n AS (SELECT max(i) + 1 AS n FROM supply)
        SELECT i, k AS j, v FROM supply, n WHERE i >= n // 3 AND i < 2 * n // 3"""
    q["matmul_dense"] = _with(EMB, EMB_POS, GRAM) + """,
        product AS (SELECT a.i, g.j, sum(a.v * g.v) AS v FROM pos a JOIN gram g ON a.k = g.i GROUP BY a.i, g.j),
        shape AS (SELECT max(p.i) + 1 AS nr, (SELECT max(j) + 1 FROM gram) AS nc FROM pos p),
        grid AS (SELECT r // nc AS i, r % nc AS j FROM shape, range(0, nr * nc) t(r))
        SELECT g.i, g.j, round(coalesce(p.v, 0.0), 6) AS v FROM grid g LEFT JOIN product p ON p.i = g.i AND p.j = g.j"""
    q["matmul_broadcast"] = _with(EMB, GRAM) + """
        SELECT a.i, g.j, round(sum(a.v * g.v), 6) AS v FROM emb a JOIN gram g ON a.k = g.i GROUP BY a.i, g.j"""
    blocks = []
    for size in ("1", "7", "nrows + 3"):
        blocks.append(f"""
        SELECT {size} AS size, b AS block, b * chunk AS start_row,
               greatest(0, least((b + 1) * chunk, nrows) - b * chunk) AS n_rows,
               b * chunk * ncols AS elem_offset,
               greatest(0, least((b + 1) * chunk, nrows) - b * chunk) * ncols AS n_elems
        FROM (SELECT nrows, ncols, ({size}) AS sz, (nrows + ({size}) - 1) // ({size}) AS chunk
              FROM (SELECT (SELECT count(*) FROM part) AS nrows,
                           (SELECT count(*) FROM supplier) AS ncols) x) y,
             range(0, sz) t(b)""")
    q["row_blocks"] = " UNION ALL ".join(blocks)
    q["row_block_assign"] = """
        SELECT p_partkey AS i, CAST(floor(p_partkey / ((n + 6) // 7)) AS BIGINT) AS block
        FROM part, (SELECT count(*) AS n FROM part) c"""
    q["gather_blocks"] = _with(SUPPLY) + "SELECT i, k AS j, v FROM supply ORDER BY i, k"
    q["matrix_diff"] = _with(SUPPLY, UPDATES, SET_SUPPLY) + """
        SELECT coalesce(a.i, b.i) AS i, coalesce(a.k, b.j) AS j, a.v AS va, b.v AS vb
        FROM supply a FULL OUTER JOIN set_supply b ON a.i = b.i AND a.k = b.j
        WHERE a.v IS DISTINCT FROM b.v"""
    q["synth_matrix"] = _with(SUPPLY) + (
        f"SELECT i, k AS j, CAST(({mix_sql('i', 'k', '314')}) % 100 AS DOUBLE) AS v FROM supply")
    return q


# ------------------------------------------------------------------ catalog

def comps_sql(p: str) -> str:
    rest = f"substr({p}, 2)"
    stripped = f"rtrim({rest}, '/')"
    return (f"(CASE WHEN {p} IS NULL OR NOT starts_with({p}, '/') THEN NULL "
            f"WHEN {rest} = '' THEN [''] "
            f"WHEN {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE string_split({stripped}, '/') END)")


def canon_sql(c: str) -> str:
    return f"(CASE WHEN len({c}) = 0 THEN '' ELSE '/' || array_to_string({c}, '/') END)"


def under_root_sql(c: str) -> str:
    return f"coalesce(len({c}) > 0 AND {c}[1] = 'static', false)"


def path_sql(line: str) -> str:
    return f"string_split(rtrim({line}, ' '), ' ')[2]"


RP = f"""rp AS (SELECT request_id, line, ts, driver, {path_sql('line')} AS path FROM requests)"""
RPC = f"""rpc AS (SELECT *, {comps_sql('path')} AS comps FROM rp)"""
FNODES = f"""fnodes AS (
  SELECT key, any_value(comps) AS comps, any_value(len(comps)) AS depth,
         first(contents ORDER BY path, contents NULLS FIRST) AS contents
  FROM (SELECT {canon_sql('comps')} AS key, * FROM (SELECT {comps_sql('path')} AS comps, path, contents FROM files) f)
  WHERE {under_root_sql('comps')} AND len(comps) >= 2 GROUP BY key)"""
FOLDERS = f"""folders AS (
  SELECT DISTINCT folder, depth FROM (
    SELECT {canon_sql('comps[1:n]')} AS folder, n AS depth
    FROM (SELECT comps, unnest(range(1, len(comps))) AS n FROM fnodes) t
    UNION ALL SELECT '/static', 1) u)"""
CHILDREN = f"""children AS (
  SELECT DISTINCT parent, name, kind FROM (
    SELECT {canon_sql('comps[1:len(comps) - 1]')} AS parent, comps[len(comps)] AS name, 'file' AS kind
    FROM fnodes
    UNION ALL
    SELECT {canon_sql('comps[1:n - 1]')} AS parent, comps[n] AS name, 'folder' AS kind
    FROM (SELECT comps, unnest(range(2, len(comps))) AS n FROM fnodes) t) u)"""
ACCEPTED = """acc AS (
  SELECT * FROM rp
  WHERE line IS NOT NULL AND line <> '' AND starts_with(line, 'GET')
    AND path IS NOT NULL AND starts_with(path, '/'))"""
SERVED = f"""served AS (
  SELECT a.request_id, a.ts, a.driver, a.path,
         CASE WHEN f.contents IS NULL THEN 404 ELSE 200 END AS status, f.contents AS body
  FROM acc a LEFT JOIN fnodes f ON f.key = {canon_sql(comps_sql('a.path'))})"""


def _verdicts(doc_seq: str, req_seq: str) -> str:
    """Verdicts of inserting documents and requests, in the order given, after the English files."""
    return _with(REQUESTS, RP) + f""",
        batch AS (
          SELECT {doc_seq} AS seq,
                 '/static/d' || CAST(doc_id % 4 AS VARCHAR) || '/e' || CAST(doc_id % 20 AS VARCHAR)
                 || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path
          FROM documents
          UNION ALL SELECT {req_seq}, path FROM rp),
        cat AS (
          SELECT -1 AS seq, {canon_sql('c')} AS key, c AS comps
          FROM (SELECT {comps_sql("'/static/d' || CAST(doc_id % 4 AS VARCHAR) || '/e' || CAST(doc_id % 20 AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR) || '.txt'")} AS c
                FROM documents WHERE lang = 'en') x),
        b AS (
          SELECT seq, path, {comps_sql('path')} AS comps,
                 CASE WHEN path IS NULL OR NOT starts_with(path, '/') THEN 'not_absolute'
                      WHEN NOT {under_root_sql(comps_sql('path'))} THEN 'wrong_root'
                      WHEN len({comps_sql('path')}) < 2 THEN 'root_only' END AS pre
          FROM batch),
        vb AS (SELECT seq, {canon_sql('comps')} AS key, comps FROM b WHERE pre IS NULL),
        allrows AS (SELECT seq, key, comps FROM cat UNION ALL SELECT seq, key, comps FROM vb),
        anc AS (SELECT seq, key, {canon_sql('comps[1:n]')} AS pkey
                FROM (SELECT seq, key, comps, unnest(range(2, len(comps))) AS n FROM allrows) t),
        -- what first made each node: a row of its own name, or one below it
        made AS (
          SELECT node, min(seq) AS s, arg_min(how, seq) AS how FROM (
            SELECT key AS node, seq, 'file' AS how FROM allrows
            UNION ALL SELECT pkey, seq, 'folder' FROM anc) e
          GROUP BY node),
        blocked AS (SELECT DISTINCT a.seq FROM anc a JOIN made m ON m.node = a.pkey
                    WHERE m.how = 'file' AND m.s < a.seq),
        judged AS (
          SELECT v.seq,
            CASE WHEN v.seq IN (SELECT seq FROM blocked) THEN 'parent_is_file'
                 WHEN m.s = v.seq THEN 'accepted'
                 WHEN m.how = 'file' THEN 'duplicate'
                 ELSE 'is_folder' END AS verdict
          FROM vb v JOIN made m ON m.node = v.key)
        SELECT b.seq, b.path, coalesce(b.pre, j.verdict) AS verdict
        FROM b LEFT JOIN judged j ON j.seq = b.seq"""


def catalog_sql() -> dict:
    q = {}
    q["path_components"] = _with(REQUESTS, RP) + f"SELECT request_id, path, {comps_sql('path')} AS comps FROM rp"
    q["path_canonical"] = _with(REQUESTS, RP, RPC) + f"SELECT request_id, {canon_sql('comps')} AS canonical FROM rpc"
    q["is_absolute"] = _with(REQUESTS, RP) + (
        "SELECT request_id, coalesce(starts_with(path, '/'), false) AS absolute FROM rp")
    q["path_part_depth"] = _with(REQUESTS, RP, RPC) + (
        "SELECT request_id, comps[1] AS part0, comps[3] AS part2, CAST(len(comps) AS BIGINT) AS depth FROM rpc")
    q["under_root"] = _with(REQUESTS, RP, RPC) + (
        f"SELECT request_id, {under_root_sql('comps')} AS under_root FROM rpc")
    q["folder_tree"] = _with(FILES, FNODES, FOLDERS) + "SELECT folder, CAST(depth AS BIGINT) AS depth FROM folders"
    q["list_children"] = _with(FILES, FNODES, CHILDREN) + "SELECT parent, name, kind FROM children"
    q["has_child"] = _with(REQUESTS, RP, RPC, FILES, FNODES, CHILDREN) + f"""
        SELECT p.parent, p.name, coalesce(h.hit, false) AS found
        FROM (SELECT {canon_sql('comps[1:len(comps) - 1]')} AS parent, comps[len(comps)] AS name
              FROM rpc WHERE len(comps) >= 1) p
        LEFT JOIN (SELECT DISTINCT parent AS pk, name, true AS hit FROM children) h
             ON h.pk = {canon_sql(comps_sql('p.parent'))} AND h.name = p.name"""
    q["read_files"] = _with(REQUESTS, RP, RPC, FILES, FNODES) + f"""
        SELECT r.request_id, r.path, f.contents
        FROM rpc r LEFT JOIN fnodes f ON f.key = {canon_sql('r.comps')}"""
    q["path_kind"] = _with(REQUESTS, RP, RPC, FILES, FNODES, FOLDERS) + f"""
        SELECT r.request_id, r.path,
          CASE WHEN r.path IS NULL OR NOT starts_with(r.path, '/') THEN 'not_absolute'
               WHEN NOT {under_root_sql('r.comps')} THEN 'outside_root'
               WHEN EXISTS (SELECT 1 FROM fnodes f WHERE f.key = {canon_sql('r.comps')}) THEN 'file'
               WHEN EXISTS (SELECT 1 FROM folders d WHERE d.folder = {canon_sql('r.comps')}) THEN 'folder'
               WHEN EXISTS (SELECT 1 FROM fnodes f, range(2, len(r.comps)) t(n)
                            WHERE f.key = {canon_sql('r.comps[1:n]')}) THEN 'below_file'
               ELSE 'missing' END AS kind
        FROM rpc r"""
    q["add_files"] = _verdicts("2 * doc_id", "2 * request_id + 1")
    verdicts = q["add_files"]
    docs = """SELECT 2 * doc_id AS seq, text AS contents FROM documents
              UNION ALL SELECT 2 * request_id + 1, line FROM rp"""
    q["add_files_accepted"] = f"SELECT v.path, c.contents FROM ({verdicts}) v JOIN (" + _with(REQUESTS, RP) + docs + \
        ") c ON c.seq = v.seq WHERE v.verdict = 'accepted'"
    q["add_files_rejected"] = f"SELECT seq, path, verdict AS reason FROM ({verdicts}) v WHERE verdict <> 'accepted'"
    # one commit after another is one batch in that order: requests, then documents
    after = 1_000_000_000_000
    judged = _verdicts(f"{after} + doc_id", "request_id")
    told = "CASE WHEN v.seq < {a} THEN 'requests' ELSE 'documents' END".format(a=after)
    docs = f"""SELECT {after} + doc_id AS seq, text AS contents FROM documents
               UNION ALL SELECT request_id, line FROM rp"""
    q["insert_files"] = f"""
        SELECT 'kept' AS batch, CAST(NULL AS BIGINT) AS seq, v.path, c.contents AS reason
        FROM ({judged}) v JOIN (""" + _with(REQUESTS, RP) + docs + f""") c ON c.seq = v.seq WHERE v.verdict = 'accepted'
        UNION ALL
        SELECT 'kept', NULL, path, contents FROM (""" + _with(FILES) + f"""SELECT path, contents FROM files
          JOIN documents ON lang = 'en' AND ends_with(path, '/' || CAST(doc_id AS VARCHAR) || '.txt')) f
        UNION ALL
        SELECT {told}, v.seq % {after}, v.path, v.verdict FROM ({judged}) v WHERE v.verdict <> 'accepted'"""
    return q


# ------------------------------------------------------------------ requests

def _fmt(status: str, body: str) -> str:
    crlf2 = "chr(13) || chr(10) || chr(13) || chr(10)"
    return (f"CASE WHEN {status} = 200 THEN 'HTTP/1.0 200 OK' || {crlf2} || coalesce({body}, '') "
            f"ELSE 'HTTP/1.0 404 Not Found' || {crlf2} END")


def requests_sql() -> dict:
    q = {}
    q["parse_requests"] = _with(REQUESTS, RP) + (
        "SELECT request_id, line, coalesce(starts_with(line, 'GET'), false) AS method_ok, path FROM rp")
    q["reject_requests"] = _with(REQUESTS, RP) + """
        SELECT request_id, reason FROM (
          SELECT request_id,
            CASE WHEN line IS NULL OR line = '' THEN 'empty_line'
                 WHEN NOT coalesce(starts_with(line, 'GET'), false) THEN 'not_get'
                 WHEN path IS NULL OR NOT starts_with(path, '/') THEN 'bad_path' END AS reason
          FROM rp) t WHERE reason IS NOT NULL"""
    base = _with(REQUESTS, RP, FILES, FNODES, ACCEPTED, SERVED)
    q["serve"] = base + "SELECT request_id, path, status, body FROM served"
    q["serve_stream"] = q["serve"]
    q["format_response"] = base + """
        SELECT request_id, status,
          CASE WHEN status = 200 THEN 'HTTP/1.0 200 OK' || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(body, '')
               ELSE 'HTTP/1.0 404 Not Found' || chr(13) || chr(10) || chr(13) || chr(10) END AS response
        FROM served"""
    q["completed_requests"] = base + """
        SELECT window_start, driver, count(*) AS n, CAST(grouping(window_start, driver) AS INTEGER) AS level
        FROM (SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start, driver FROM served) t
        GROUP BY ROLLUP (window_start, driver)"""
    q["completed_requests_stream"] = base + """
        SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start, driver, count(*) AS n
        FROM served GROUP BY time_bucket(INTERVAL '10 seconds', ts), driver"""
    arrivals = """,
        arrivals AS (SELECT event_id, CAST(floor(event_id * 3 / (SELECT max(event_id) + 1 FROM events)) AS INTEGER)
                            + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS arrival FROM events)"""
    q["completed_requests_late"] = base + arrivals + """,
        timed AS (SELECT s.driver, a.arrival, s.ts, time_bucket(INTERVAL '10 seconds', s.ts) AS window_start
                  FROM served s JOIN arrivals a ON a.event_id = s.request_id),
        high AS (SELECT b.arrival, max(t.ts) - INTERVAL 5 DAY AS watermark
                 FROM (SELECT DISTINCT arrival FROM timed) b JOIN timed t ON t.arrival < b.arrival GROUP BY b.arrival),
        judged AS (SELECT t.*, coalesce(t.window_start + INTERVAL 10 SECOND <= h.watermark, false) AS late
                   FROM timed t LEFT JOIN high h ON h.arrival = t.arrival)
        SELECT window_start, driver, count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS n_late
        FROM judged GROUP BY window_start, driver"""
    q["serve_live"] = base + arrivals + """,
        english AS (SELECT DISTINCT '/' || CAST(doc_id AS VARCHAR) || '.txt' AS name FROM documents WHERE lang = 'en')
        SELECT request_id, path, CASE WHEN seen THEN status ELSE 404 END AS status, CASE WHEN seen THEN body END AS body
        FROM (SELECT s.*, a.arrival > 0 OR s.status = 404 OR regexp_extract(rtrim(s.path, '/'), '/[^/]*$') IN (SELECT name FROM english) AS seen
              FROM served s JOIN arrivals a ON a.event_id = s.request_id) t"""
    q["response_check"] = base + """,
        expected AS (
          SELECT a.request_id, CASE WHEN f.contents IS NULL THEN 404 ELSE 200 END AS status, f.contents AS body
          FROM acc a LEFT JOIN files f ON f.path = regexp_replace(a.path, '/+$', '')),
        w AS (SELECT request_id, """ + _fmt("status", "body") + """ AS resp FROM expected),
        english AS (
          SELECT a.request_id, CASE WHEN e.contents IS NULL THEN 404 ELSE 200 END AS status, e.contents AS body
          FROM acc a LEFT JOIN (
            SELECT f.key, f.contents FROM fnodes f
            JOIN documents d ON d.lang = 'en' AND ends_with(f.key, '/' || CAST(d.doc_id AS VARCHAR) || '.txt')) e
            ON e.key = """ + canon_sql(comps_sql("a.path")) + """),
        g AS (SELECT request_id, """ + _fmt("status", "body") + """ AS resp FROM english)
        SELECT coalesce(w.request_id, g.request_id) AS request_id, w.resp AS want, g.resp AS got,
               CAST(length(g.resp) AS INTEGER) AS n_chars
        FROM w FULL OUTER JOIN g ON w.request_id = g.request_id
        WHERE w.resp IS DISTINCT FROM g.resp"""
    return q


def all_sql() -> dict:
    out = {}
    out.update(graph_sql())
    out.update(matrix_sql())
    out.update(catalog_sql())
    out.update(requests_sql())
    return out
