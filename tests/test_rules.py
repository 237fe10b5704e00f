"""Path and request-line rules: Spark expressions, the DuckDB oracle text and
a model of Java's ``split`` must agree, on edge cases and on random input."""

import random

import duckdb

from tests.test_catalog import EDGE_PATHS, java_components
from trellis.functions import paths as P
from trellis.functions.http import request_path
from trellis.oracle import canon_sql, comps_sql, path_sql


def java_split_space(line):
    """``line.split(" ")`` in Java: trailing empty strings removed."""
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts if parts else [""] if line == "" else parts


def random_paths(n, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        out.append("".join(rnd.choice(["/", "/", "a", "b", "static", ""]) for _ in range(rnd.randint(0, 7))))
    return out


def test_oracle_sql_agrees_on_edge_paths():
    con = duckdb.connect()
    for p, want in EDGE_PATHS.items():
        got = con.execute(f"SELECT {comps_sql('p')} FROM (SELECT CAST(? AS VARCHAR) AS p)", [p]).fetchone()[0]
        assert got == want, p
        if want is not None:
            key = con.execute(f"SELECT {canon_sql(comps_sql('p'))} FROM (SELECT CAST(? AS VARCHAR) AS p)", [p]).fetchone()[0]
            assert key == ("" if not want else "/" + "/".join(want))


def test_random_paths_match_java_split(spark):
    paths = random_paths(3000, 1)
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r["path"]: (None if r["c"] is None else list(r["c"]))
           for r in df.select("path", P.path_components("path").alias("c")).collect()}
    for p in paths:
        want = java_components(p) if p.startswith("/") else None
        assert got[p] == want, p
    con = duckdb.connect()
    for p in paths[:300]:
        assert con.execute(f"SELECT {comps_sql('p')} FROM (SELECT CAST(? AS VARCHAR) AS p)", [p]).fetchone()[0] == got[p], p


def test_random_request_lines(spark):
    rnd = random.Random(2)
    lines = ["".join(rnd.choice(["GET", " ", " ", "/a", "x", "POST"]) for _ in range(rnd.randint(0, 6)))
             for _ in range(3000)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i bigint, line string")
    got = {r["i"]: r["p"] for r in df.select("i", request_path("line").alias("p")).collect()}
    con = duckdb.connect()
    for i, s in enumerate(lines):
        parts = java_split_space(s)
        want = parts[1] if len(parts) > 1 else None
        assert got[i] == want, repr(s)
        if i < 300:
            assert con.execute(f"SELECT {path_sql('s')} FROM (SELECT CAST(? AS VARCHAR) AS s)", [s]).fetchone()[0] == want, repr(s)
