import hashlib
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from trellis.llm import code_search as C

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("label", T.IntegerType())])


def brute(rows, rounds=2):
    """{row: (code, error, label_error)} and digest, every entry tried."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    d = width // 16
    ints = [[math.floor(256 * x) if abs(x) < 2.0 ** 60 else 256 * int(x) for x in v] if len(v) == width else None for _, v, _ in kept]
    first = [x for x in ints if x][:64]
    books = [[x[p * d:(p + 1) * d] for x in first] for p in range(16)]

    def near(p, x):
        own = x[p * d:(p + 1) * d]
        return min((sum((a - b) ** 2 for a, b in zip(own, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(16):
            own = {}
            for x in ints:
                if x:
                    own.setdefault(near(p, x)[1], []).append(x[p * d:(p + 1) * d])
            new.append([[sum(c) // len(own[k]) for c in zip(*own[k], strict=True)] if k in own else e for k, e in enumerate(books[p])])
        books = new
    out, labels = [], {}
    for (i, _, lab), x in zip(kept, ints, strict=True):
        found = [near(p, x) for p in range(16)] if x else None
        error = sum(f for f, _ in found) if x else None
        out.append([i, "".join(f"{k:02x}" for _, k in found) if x else None, error, lab])
        if x:
            labels[lab] = labels.get(lab, 0) + error
    text = ",".join(str(c) for b in books for e in b for c in e)
    fit = lambda e: e if e is None or e < 1 << 63 else None
    return sorted(((i, c, fit(e), fit(labels.get(lab))) for i, c, e, lab in out), key=str), hashlib.sha256(text.encode()).hexdigest()


def vector_rows(n, width, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        v = [round(r.gauss(0, 0.3) if k % 3 else r.choice([-0.5, 0.0, 0.25]), 2) for k in range(width)]
        rows.append((i * 3 % 97, v, r.choice([None, 1, 2])))        # ids repeat
    rows += [(1000 + i, rows[0][1], 7) for i in range(20)]         # copies
    return rows + [(None, rows[1][1], 1), (-5, None, 1), (5, [None] + [0.0] * (width - 1), 1), (6, [math.nan] * width, 2),
                   (7, [math.inf] * width, 2), (8, [0.0] * (width + 16), 2), (9, [], 2)]


def run(spark, rows):
    out = C.compress(spark.createDataFrame(rows, VECTORS).repartition(3)).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in out), key=str), {r.codebooks_sha256 for r in out}


@pytest.mark.parametrize("n,width", [(150, 32), (30, 16), (90, 64)])
def test_against_trying_every_entry(spark, n, width):
    got, digests = run(spark, vector_rows(n, width))
    want, digest = brute(vector_rows(n, width))
    assert got == want and digests == {digest}


def test_components_beyond_64_bits(spark):
    rows = vector_rows(70, 16)[:70]
    rows += [(2000 + i, [1e30 * (i + 1), -1e300, 5e15 + i] + [0.5] * 13, 3) for i in range(5)]
    got, digests = run(spark, rows)
    want, digest = brute(rows)
    assert got == want and digests == {digest}
    assert any(e is None for _, c, e, _ in got if c)


def test_nearest_looks_at_few_entries_and_keeps_ties():
    r = np.random.default_rng(5)
    entries = r.integers(-300, 300, (64, 4))
    entries[40] = entries[3]
    entries[41] = entries[3][::-1]                          # equal sum
    parts = np.concatenate([r.integers(-300, 300, (4000, 4)), entries, entries + 1])
    found, far, computed = C.Codebook(entries).nearest(parts)
    all_far = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (found == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()
    assert computed < 0.75 * len(parts) * 64


def test_floor_of_products():
    rows, x = C.whole(pa.array([[-0.001, 0.999, 1e4, -1e300] + [0.0] * 12, None, [1.0]], pa.list_(pa.float64())), 16)
    assert rows.tolist() == [0] and x[0, :3].tolist() == [-1, 255, 2560000] and x[0, 3] == 256 * int(-1e300)


def test_empty_and_clashing_columns(spark):
    assert C.compress(spark.createDataFrame([], VECTORS)).count() == 0
    assert C.compress(spark.createDataFrame([(1, None, 1)], VECTORS)).count() == 0
    only = C.compress(spark.createDataFrame([(1, [0.1] * 7, 1)], VECTORS)).first()
    assert only.code is None and only.error is None
    from pyspark.sql import functions as F
    df = spark.createDataFrame(vector_rows(20, 16), VECTORS).select(
        "*", *[F.lit("x").alias(c) for c in ("vec", "code", "error", "own", "part", "entry", "label_error")])
    assert C.compress(df).count() == 20 + 20 + 1 + 2


def test_query_against_sql(spark, tmp_path):
    rows = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(0, 0.1, 64)], i % 4 or None) for i in range(200)]
    schema = T.StructType([VECTORS[0], T.StructField("embedding", T.ArrayType(T.FloatType())), VECTORS[2]])
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = sorted(tuple(r) for r in C.op11_equal_average(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert out == sorted(con.execute(C.oracle_sql()).fetchall())
