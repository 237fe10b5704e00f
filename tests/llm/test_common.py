import random

import numpy as np
import pyarrow as pa

from trellis.llm import common as C


def parted(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def test_word_hashes_do_not_depend_on_windows(monkeypatch):
    r = random.Random(1)
    for _ in range(60):
        texts = ["".join(r.choice("ab \n\té") for _ in range(r.choice([0, 1, 3, 40]))) for _ in range(r.randint(0, 8))]
        data, offsets = parted(texts)
        words = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        monkeypatch.setattr(C, "HASH_WINDOW", 1 << 20)
        whole, at = C.word_hashes(data, offsets)
        assert np.diff(at).tolist() == [sum(map(bool, w)) for w in words]
        flat = [w for own in words for w in own if w]
        assert len({(w, h) for w, h in zip(flat, whole.tolist(), strict=True)}) == len(set(flat)) == len(set(whole.tolist()))
        for size in (1, 2, 7):
            monkeypatch.setattr(C, "HASH_WINDOW", size)
            again, at2 = C.word_hashes(data, offsets)
            assert (again == whole).all() and (at2 == at).all()


def test_long_words_differ_wherever_they_do(monkeypatch):
    a = np.full(300_000, ord("x"), np.uint8)
    b, c = a.copy(), a.copy()
    b[70_000], c[70_000 + 65_536] = ord("y"), ord("y")
    hashes = [C.word_hashes(x, np.array([0, len(x)]))[0][0] for x in (a, b, c, a[:-1])]
    assert len(set(map(int, hashes))) == 4
    monkeypatch.setattr(C, "HASH_WINDOW", 10_007)
    assert [C.word_hashes(x, np.array([0, len(x)]))[0][0] for x in (a, b, c, a[:-1])] == hashes


def test_memo_is_bounded_in_bytes():
    memo = C.Memo(limit=10_000)
    for i in range(20):
        memo.put(str(i) * 100, b"x" * 100)
    assert len(memo) == 20
    memo.trim()
    assert len(memo) == 20 and memo.used < 10_000
    memo.put("one long text" * 1000, b"")
    memo.trim()
    assert not memo and memo.used == 0


def test_gathered_keeps_rows_in_order():
    batches = [pa.RecordBatch.from_arrays([pa.array([str(i)] * n)], ["t"]) for i, n in enumerate([3, 0, 5, 1, 1])]
    for limit in (1, 8, 10 ** 6):
        out = list(C.gathered(batches, 0, limit))
        assert [x for b in out for x in b.column(0).to_pylist()] == [x for b in batches for x in b.column(0).to_pylist()]
    assert len(out) == 1 and not list(C.gathered([], 0, 5))


def test_batches_are_bounded_in_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    df = spark.range(3000).selectExpr("repeat('x', 5000) AS t").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    try:
        spark.conf.set(key, str(64 << 20))
        assert max(r.n for r in C.map_arrow(df, sizes, "n long").collect()) < 2 * C.BATCH_BYTES
        spark.conf.set(key, str(1 << 20))                    # a session's own bound stays
        assert max(r.n for r in C.map_arrow(df, sizes, "n long").collect()) < 2 << 20
    finally:
        spark.conf.set(key, before.rstrip("b"))
