import numpy as np
import pytest
from pyspark.sql import types as T

from trellis.llm import multi_index as M

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("key", T.StringType()),
                       T.StructField("cells", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "k", "c")
                                  for i, v in rows], SCHEMA)


def vectors():
    r = np.random.default_rng(2)
    out = [(i, r.normal(size=16).astype(np.float32)) for i in range(300)]
    for g in range(5):
        base = r.normal(size=16)
        for k in range(12):
            out.append((1000 + 100 * g + k, (base + 0.07 * r.normal(size=16)).astype(np.float32)))
    out += [(2000, out[0][1]), (2001, out[0][1]), (2002, (3 * out[0][1]).astype(np.float32))]
    return out


def brute(rows):
    x = np.stack([np.asarray(v, float) for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = x @ x.T >= M.THRESHOLD
    np.fill_diagonal(link, False)
    ids = np.array([i for i, _ in rows])
    comp = ids.copy()
    while True:
        new = np.array([min(comp[i], comp[link[i]].min(initial=10 ** 9)) for i in range(len(ids))])
        if (new == comp).all():
            return link, {int(i): (int(n), int(c)) for i, n, c in zip(ids, link.sum(1), comp, strict=True)}
        comp = new


@pytest.mark.parametrize("small", [False, True])
def test_links_against_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(M, "BLOCK_STORED", 4)
        monkeypatch.setattr(M, "BLOCK_VISITORS", 7)
    rows = vectors()
    link, want = brute(rows)
    out = M.near_duplicates(frame(spark, rows), centroids=4).collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in out}
    assert sum(n for n, _ in got.values()) >= 0.99 * link.sum()
    assert all(got[i][0] <= want[i][0] for i in want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    close = [i for i in want if i >= 1000]
    assert all(got[i] == want[i] for i in close)


def test_undefined_vectors_link_with_nothing(spark):
    one = [1.0, 0.0, 0.0, 0.0]
    rows = [(1, one), (2, one), (3, None), (4, []), (5, [0.0] * 4), (6, [float("nan"), 1, 0, 0]), (7, [None, 1.0, 0, 0]),
            (8, [float("inf"), 0, 0, 0]), (None, one), (9, [1.0]), (10, [1.0]), (2, one), (11, [-1.0, 0, 0, 0]), (12, [1.0, 0.0])]
    out = sorted((r.vec_id or -1, r.n_links, r.component_id) for r in M.near_duplicates(frame(spark, rows)).collect() if r.vec_id)
    assert out == [(1, 2, 1), (2, 2, 1), (2, 2, 1), *[(i, 0, i) for i in (3, 4, 5, 6, 7, 8)], (9, 1, 9), (10, 1, 9),
                   (11, 0, 11), (12, 0, 12)]


def test_empty_table(spark):
    assert M.near_duplicates(frame(spark, [])).count() == 0
    assert M.near_duplicates(frame(spark, [(1, None)])).first().n_links == 0


def test_multi_sequence_visits_cells_in_order():
    r = np.random.default_rng(1)
    a, b = r.random(6), r.random(5)
    got = M.multi_sequence(a, b, 0.9)
    total = (a[:, None] + b[None, :]).ravel()
    assert sorted(got) == sorted(np.flatnonzero(total <= 0.9).tolist())
    assert (np.diff(total[got]) >= 0).all()


def unit(x):
    return x / np.linalg.norm(x, axis=1)[:, None]


def shaped(kind, n, r):
    """Vectors that differ along few directions, as real ones do."""
    if kind.startswith("rank"):
        k = int(kind[4:])
        return r.standard_normal((n, k)) @ r.standard_normal((k, 64))
    if kind == "noisy":
        return r.standard_normal((n, 4)) @ r.standard_normal((4, 128)) + 0.05 * r.standard_normal((n, 128))
    if kind == "half":
        return np.concatenate([r.standard_normal((n, 3)) @ r.standard_normal((3, 32)), np.full((n, 32), 0.7)], axis=1)
    if kind == "segments":
        centres, t = r.standard_normal((40, 64)), r.random(n)[:, None]
        return centres[r.integers(40, size=n)] * t + centres[r.integers(40, size=n)] * (1 - t)
    return np.repeat(r.standard_normal((n // 12, 64)), 12, axis=0) + 0.15 * r.standard_normal((n // 12 * 12, 64))


@pytest.mark.parametrize("kind", ["rank3", "rank6", "rank10", "noisy", "half", "segments", "clusters"])
def test_recall_against_all_pairs(kind):
    r = np.random.default_rng(8)
    x = unit(shaped(kind, 9000 if kind == "rank10" else 4200, r))
    index = M.fit(x, 8)
    home, visits = index.home(x), [set(v.tolist()) for v in index.visits(x)]
    a, b = np.nonzero(np.triu(x @ x.T >= M.THRESHOLD, 1))
    some = r.permutation(len(a))[:30_000]
    found = [home[j] in visits[i] or home[i] in visits[j] for i, j in zip(a[some], b[some], strict=True)]
    assert len(found) > 50 and np.mean(found) >= 0.995
    assert index.reach <= (2 - 2 * M.THRESHOLD) * 1.001


def test_links_of_low_rank_vectors(spark):
    x = shaped("noisy", 1500, np.random.default_rng(6)).astype(np.float32)
    link, want = brute(list(enumerate(x)))
    got = {v.vec_id: v for v in M.near_duplicates(frame(spark, list(enumerate(x))), centroids=6).collect()}
    assert sum(v.n_links for v in got.values()) >= 0.995 * link.sum() and link.sum() > 10_000
    assert all(v.n_links <= want[i][0] for i, v in got.items())


def test_finite_vectors_of_any_size(spark):
    schema = T.StructType([SCHEMA[0], T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1.0, 1.0]), (4, [1.0, -1.0])]
    out = M.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4)]


def test_query(spark, tmp_path):
    rows = vectors()
    frame(spark, rows).select("vec_id", "embedding", "label").write.parquet(str(tmp_path / "embeddings.parquet"))
    _, want = brute(rows)
    out = M.op2_multi_index(spark, str(tmp_path)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out} == {i: (n, c, i == c) for i, (n, c) in want.items()}
