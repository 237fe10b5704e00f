"""Paths and the file catalog, checked against a sequential tree simulator."""

import random

from pyspark.sql import functions as F

from trellis.functions import paths as P
from trellis.operators import catalog as C
from trellis.sources.files import load_files

EDGE_PATHS = {
    "/static/A.txt": ["static", "A.txt"],
    "/static/A.txt/": ["static", "A.txt"],
    "/": [""],
    "//": [],
    "///": [],
    "/static": ["static"],
    "/static/": ["static"],
    "/static//A.txt": ["static", "", "A.txt"],
    "//static/A.txt": ["", "static", "A.txt"],
    "static/A.txt": None,
}

TINY_FILES = [("/static/A.txt", "11111"), ("/static/B.txt", "2222222222"),
              ("/static/dir1/C.txt", "3333333333"), ("/static/dir3/dir4/E.txt", "4444444444")]


def test_path_components(spark):
    df = spark.createDataFrame([(p,) for p in EDGE_PATHS], "path string")
    got = {r["path"]: (None if r["c"] is None else list(r["c"]))
           for r in df.select("path", P.path_components("path").alias("c")).collect()}
    assert got == EDGE_PATHS
    canon = {r["path"]: r["k"] for r in df.select(
        "path", P.path_canonical(P.path_components("path")).alias("k")).collect()}
    assert canon["/static/A.txt/"] == "/static/A.txt"
    assert canon["/"] == "/" and canon["//"] == ""
    assert canon["/static//A.txt"] == "/static//A.txt"
    roots = {r["path"]: r["u"] for r in df.select(
        "path", P.under_root(P.path_components("path")).alias("u")).collect()}
    assert [p for p, u in roots.items() if u] == [
        "/static/A.txt", "/static/A.txt/", "/static", "/static/", "/static//A.txt"]


def test_path_part_depth(spark):
    df = spark.createDataFrame([("/static/dir1/C.txt",)], "path string")
    c = P.path_components("path")
    r = df.select(P.path_part(c, 1).alias("p1"), P.path_part(c, 5).alias("p5"),
                  P.path_depth(c).alias("d")).first()
    assert (r["p1"], r["p5"], r["d"]) == ("dir1", None, 3)


def files_df(spark, rows=TINY_FILES):
    return spark.createDataFrame(rows, "path string, contents string")


def test_tree_and_children(spark):
    f = files_df(spark)
    tree = {(r["folder"], r["depth"]) for r in C.folder_tree(f).collect()}
    assert tree == {("/static", 1), ("/static/dir1", 2), ("/static/dir3", 2), ("/static/dir3/dir4", 3)}
    empty = spark.createDataFrame([], "path string, contents string")
    assert [tuple(r) for r in C.folder_tree(empty).collect()] == [("/static", 1)]
    kids = {tuple(r) for r in C.list_children(f).collect()}
    assert ("/static", "dir3", "folder") in kids and ("/static/dir3/dir4", "E.txt", "file") in kids
    assert len(kids) == 7
    probe = spark.createDataFrame([("/static", "dir1"), ("/static/", "A.txt"), ("/static", "nope")],
                                  "parent string, name string")
    found = {(r["parent"], r["name"]): r["found"] for r in C.has_child(C.list_children(f), probe).collect()}
    assert found == {("/static", "dir1"): True, ("/static/", "A.txt"): True, ("/static", "nope"): False}


def test_read_files_and_kinds(spark):
    f = files_df(spark)
    wanted = spark.createDataFrame([(p,) for p in [
        "/static/A.txt", "/static/A.txt/", "/static/dir1", "/static/A.txt/x", "/static/missing.txt",
        "/static/missingdir/missing.txt", "/other/A.txt", "static/A.txt", "/static//A.txt", "/static"]],
        "path string")
    got = {r["path"]: r["contents"] for r in C.read_files(f, wanted).collect()}
    assert got["/static/A.txt"] == "11111" and got["/static/A.txt/"] == "11111"
    assert sum(v is not None for v in got.values()) == 2
    kinds = {r["path"]: r["kind"] for r in C.path_kind(f, wanted).collect()}
    assert kinds == {
        "/static/A.txt": "file", "/static/A.txt/": "file", "/static/dir1": "folder",
        "/static/A.txt/x": "below_file", "/static/missing.txt": "missing",
        "/static/missingdir/missing.txt": "missing", "/other/A.txt": "outside_root",
        "static/A.txt": "not_absolute", "/static//A.txt": "missing", "/static": "folder"}


# ---------------------------------------------------------------- inserts

def java_components(p):
    rest = p[1:]
    if rest == "":
        return [""]
    parts = rest.split("/")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


class SeqFs:
    """Sequential tree with the reference's insert rules (for brute force)."""

    def __init__(self):
        self.root = {}

    def add(self, path):
        if path is None or not path.startswith("/"):
            return "not_absolute"
        c = java_components(path)
        if not c or c[0] != "static":
            return "wrong_root"
        if len(c) == 1:
            return "root_only"
        cur = self.root
        for idx in range(1, len(c)):
            nxt = cur.get(c[idx])
            if idx < len(c) - 1:
                if nxt is None:
                    nxt = cur[c[idx]] = {}
                elif isinstance(nxt, str):
                    return "parent_is_file"
                cur = nxt
            elif nxt is None:
                cur[c[idx]] = "file"
                return "accepted"
            else:
                return "duplicate" if isinstance(nxt, str) else "is_folder"


def test_tiny_inserts(spark):
    batch = ["/static/a", "/static/a", "/static/a/b", "/static/d/x", "/static/d", "/static",
             "/other/a", "a"]
    b = spark.createDataFrame([(i, p, "x") for i, p in enumerate(batch)], "seq bigint, path string, contents string")
    empty = spark.createDataFrame([], "path string, contents string")
    got = [r["verdict"] for r in C.classify_inserts(empty, b).orderBy("seq").collect()]
    assert got == ["accepted", "duplicate", "parent_is_file", "accepted", "is_folder", "root_only",
                   "wrong_root", "not_absolute"]
    acc, rej = C.add_files(empty, b)
    assert acc.count() == 2 and rej.count() == 6


def test_inserts_match_sequential_rule(spark):
    rnd = random.Random(11)
    names = ["a", "b", ""]
    cat_rows, batch_rows, want = [], [], {}
    for g in range(150):
        fs = SeqFs()
        for _ in range(rnd.randint(0, 2)):
            p = f"/static/g{g}/" + "/".join(rnd.choice(names[:2]) for _ in range(rnd.randint(1, 3)))
            if fs.add(p) == "accepted":
                cat_rows.append((p, "c"))
        for pos in range(rnd.randint(1, 8)):
            depth = rnd.randint(0, 3)
            p = f"/static/g{g}" + "".join("/" + rnd.choice(names) for _ in range(depth))
            if rnd.random() < 0.15:
                p += "/"
            seq = g * 100 + pos
            batch_rows.append((seq, p, "x"))
            want[seq] = fs.add(p)
    for seq, p in [(10 ** 6, "/static"), (10 ** 6 + 1, "//"), (10 ** 6 + 2, "rel/a")]:
        batch_rows.append((seq, p, "x"))
        want[seq] = SeqFs().add(p)
    cat = spark.createDataFrame(cat_rows, "path string, contents string")
    b = spark.createDataFrame(batch_rows, "seq bigint, path string, contents string")
    got = {r["seq"]: r["verdict"] for r in C.classify_inserts(cat, b).collect()}
    bad = {s: (got[s], want[s]) for s in want if got[s] != want[s]}
    assert not bad


def test_load_files(spark, tmp_path):
    for p, body in TINY_FILES:
        f = tmp_path / p[len("/static/"):]
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(body)
    got = {r["path"]: r["contents"] for r in load_files(spark, str(tmp_path)).collect()}
    assert got == dict(TINY_FILES)


def test_append_files_never_overwrites_or_repeats(spark, tmp_path):
    out = str(tmp_path / "catalog")
    acc = files_df(spark)
    C.append_files(acc, out)
    more = spark.createDataFrame([("/static/A.txt", "other"), ("/static/A.txt/", "other"), ("/static/new", "n")],
                                 "path string, contents string")
    C.append_files(more, out)
    C.append_files(more, out)
    rows = {r.path: r.contents for r in spark.read.parquet(out).collect()}
    assert len(rows) == spark.read.parquet(out).count() == len(TINY_FILES) + 1
    assert rows["/static/A.txt"] == "11111" and rows["/static/new"] == "n"


def test_rows_without_an_own_seq_are_rejected(spark):
    b = spark.createDataFrame([(1, "/static/a", "x"), (1, "/static/b", "y"), (None, "/static/c", "z"),
                               (None, None, None), (2, "/static/a", "v"), (3, "/static/a/", "w")],
                              "seq bigint, path string, contents string")
    empty = spark.createDataFrame([], "path string, contents string")
    got = sorted((str(r.seq), str(r.path), r.verdict) for r in C.classify_inserts(empty, b).collect())
    assert got == [("1", "/static/a", "repeated_seq"), ("1", "/static/b", "repeated_seq"), ("2", "/static/a", "accepted"),
                   ("3", "/static/a/", "duplicate"), ("None", "/static/c", "no_seq"), ("None", "None", "no_seq")]
    acc, rej = C.add_files(empty, b)
    assert acc.count() == 1 and rej.count() == 5


def test_one_node_per_name(spark):
    f = spark.createDataFrame([("/static/a", "2"), ("/static/a/", "0"), ("/static/a", "1")], "path string, contents string")
    assert [tuple(r) for r in C.file_nodes(f).collect()] == [("/static/a", "1")]
    assert C.list_children(f).count() == 1


def test_path_before_a_line_break(spark):
    df = spark.createDataFrame([("/static/a/\n",), ("/static/a/ ",)], "path string")
    got = [r.c for r in df.select(P.path_components("path").alias("c")).collect()]
    assert got == [["static", "a", "\n"], ["static", "a", " "]]


def test_keys_equal_canonical_components(spark):
    rnd = random.Random(3)
    paths = [None, "", "/", "//", "/static", "/static/", "a/b"] + [
        "/" + "".join(rnd.choice("ab//") for _ in range(rnd.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    c = P.path_components("path")
    k = F.col("k")
    out = df.select(c.alias("c"), P.path_canonical(c).alias("want"), P.path_key("path").alias("k"))
    for r in out.select("*", P.key_depth(k).alias("d"), P.key_parent(k).alias("up"), P.key_name(k).alias("name")).collect():
        assert r.k == r.want
        if r.c:
            assert r.d == len(r.c) and r.name == r.c[-1] and r.up == "".join("/" + x for x in r.c[:-1])


def test_files_are_loaded_whole(spark, tmp_path):
    """A file of many lines, breaks of all kinds and a last line without one is one row."""
    want = {"/static/a.txt": "one\ntwo\r\nthree\n\n", "/static/d/e/b c.txt": "\n", "/static/d/long.txt": "line\n" * 5000 + "end",
            "/static/d/plain": "x"}
    for path, contents in want.items():
        file = tmp_path / path.removeprefix("/static/")
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(contents.encode())
    assert {r.path: r.contents for r in load_files(spark, str(tmp_path)).collect()} == want
