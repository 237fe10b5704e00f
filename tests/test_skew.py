"""Hot keys: one key holds a third of all rows.

Broadcast joins are switched off and AQE's skew thresholds lowered, so the
sort-merge joins run and skewed partitions are split; results must still
equal a brute-force computation.
"""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_catalog import SeqFs
from trellis.operators import catalog as C
from trellis.operators import matrix as M
from trellis.operators import requests as R
from trellis.plans.pagerank import pagerank


@pytest.fixture()
def skewed(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_file_requests(skewed):
    spark = skewed
    files = spark.createDataFrame([(f"/static/f{i}.txt", f"body{i}") for i in range(50)],
                                  "path string, contents string")
    rows = []
    for rid in range(3000):
        target = 7 if rid % 3 == 0 else rid % 60  # a third of requests hit one file
        rows.append((rid, f"GET /static/f{target}.txt HTTP/1.1", rid % 5, None))
    req = spark.createDataFrame(rows, "request_id bigint, line string, driver bigint, ts timestamp_ntz")
    got = {r["request_id"]: (r["status"], r["body"]) for r in R.serve(req, files).collect()}
    for rid, line, _, _ in rows:
        n = int(line.split("/static/f")[1].split(".txt")[0])
        assert got[rid] == ((200, f"body{n}") if n < 50 else (404, None))
    kinds = Counter(r["kind"] for r in C.path_kind(files, R.parse_requests(req).select("path")).collect())
    assert kinds == Counter({"file": sum(1 for r in rows if int(r[1].split("/static/f")[1].split(".txt")[0]) < 50),
                             "missing": sum(1 for r in rows if int(r[1].split("/static/f")[1].split(".txt")[0]) >= 50)})


def test_hot_k_product(skewed):
    spark = skewed
    rng = np.random.default_rng(5)
    a = np.zeros((60, 40))
    b = np.zeros((40, 30))
    a[:, 3] = rng.integers(1, 5, 60)   # column 3 of a and row 3 of b are hot
    b[3, :] = rng.integers(1, 5, 30)
    a[rng.integers(0, 60, 200), rng.integers(0, 40, 200)] = 2.0
    b[rng.integers(0, 40, 100), rng.integers(0, 30, 100)] = 3.0

    def cells(x):
        return spark.createDataFrame([(i, j, float(v)) for (i, j), v in np.ndenumerate(x) if v],
                                     "i bigint, j bigint, v double")
    out = np.zeros((60, 30))
    for r in M.matmul_cells(cells(a), cells(b)).collect():
        out[r["i"], r["j"]] = r["v"]
    assert np.array_equal(out, a @ b)


def test_hot_folder_inserts(skewed):
    spark = skewed
    batch = []
    for seq in range(600):
        if seq % 3 == 0:
            p = f"/static/hot/x{seq % 40}/f{seq % 7}"  # a third of rows under one folder
        else:
            p = f"/static/cold{seq % 30}/f{seq % 11}"
        batch.append((seq, p, "x"))
    batch.append((600, "/static/hot", "x"))
    batch.append((601, "/static/hot/x1/f1/deeper", "x"))
    fs = SeqFs()
    want = {seq: fs.add(p) for seq, p, _ in batch}
    b = spark.createDataFrame(batch, "seq bigint, path string, contents string")
    empty = spark.createDataFrame([], "path string, contents string")
    got = {r["seq"]: r["verdict"] for r in C.classify_inserts(empty, b).collect()}
    assert got == want


def test_hub_pagerank_salted_under_skew(skewed):
    spark = skewed
    n = 90
    rows = [(0, d) for d in range(1, n)] * 2 + [(d, (d * 7) % n) for d in range(1, n)]
    links = spark.createDataFrame(rows, "src bigint, dst bigint")
    r0 = spark.range(n).select("id", F.lit(1.0).alias("rank"))
    a = {r["id"]: r["rank"] for r in pagerank(links, r0, 3, strategy="broadcast").collect()}
    b = {r["id"]: r["rank"] for r in pagerank(links, r0, 3, strategy="salted", salt_bucket_rows=8).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-9
