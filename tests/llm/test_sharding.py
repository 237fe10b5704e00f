import math
import struct
from collections import Counter

import pytest
import xxhash

from tests.llm.cases import docs_frame, edge_rows
from trellis.llm import sharding as S
from pyspark.sql import functions as F


def shards(spark, n, weights):
    df = spark.range(n).withColumnRenamed("id", "doc_id")
    return {r.doc_id: r.shard for r in S.assign(df, "doc_id", weights).collect()}


def test_a_new_shard_takes_rows_only_into_itself(spark):
    before, after = shards(spark, 4000, [1.0] * 16), shards(spark, 4000, [1.0] * 17)
    moved = [i for i in before if before[i] != after[i]]
    assert moved and all(after[i] == 16 for i in moved)
    assert 0.5 < len(moved) / (4000 / 17) < 1.5


def test_weights_set_the_shares(spark):
    n = Counter(shards(spark, 6000, [1.0, 2.0, 3.0]).values())
    assert abs(n[0] - 1000) < 150 and abs(n[1] - 2000) < 180 and abs(n[2] - 3000) < 200


def test_slots_are_gapless_and_edges(spark):
    df = docs_frame(spark, edge_rows() + [(i, "t") for i in range(100, 400)]).repartition(5)
    out = S.place(df, "doc_id", [1.0] * 4, F.col("doc_id")).collect()
    assert len(out) == df.count()
    for s in range(4):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in out if r.doc_id == 8}) == 1
    assert S.place(docs_frame(spark, []), "doc_id", [1.0], F.col("doc_id")).count() == 0


def test_same_shards_for_any_order(spark):
    df = docs_frame(spark, edge_rows())
    a = S.assign(df.repartition(3), "doc_id", [1.0] * 8, into="to").select("doc_id", "to").collect()
    b = S.assign(df.coalesce(1), "doc_id", [1.0] * 8, into="to").select("doc_id", "to").collect()
    assert Counter(a) == Counter(b)


def plain_shard(key, weights):
    """Rendezvous hashing a key at a time."""
    scores = []
    for s, w in enumerate(weights):
        h = xxhash.xxh64(("\x00" if key is None else str(key)).encode(), seed=42).intdigest()
        h = xxhash.xxh64(struct.pack("<i", s), seed=h).intdigest()
        scores.append((w / -math.log(((h >> 11) + 0.5) * 2.0 ** -53), -s))
    return -max(scores)[1]


def test_shards_against_plain_rendezvous(spark):
    rows = edge_rows() + [(i, "t") for i in range(500, 900)] + [(-7, "t"), (2 ** 62, "t")]
    for weights in ([1.0] * 16, [1.0, 5.0, 0.5]):
        out = S.assign(docs_frame(spark, rows, clashes=False), "doc_id", weights).collect()
        assert all(r.shard == plain_shard(r.doc_id, weights) for r in out) and len(out) == len(rows)


def test_a_column_that_clashes_is_kept(spark, tmp_path):
    df = docs_frame(spark, edge_rows()).withColumn("shard", F.lit("mine"))
    out = S.assign(df, "doc_id", [1.0] * 4)
    assert out.columns == [*df.columns, "_shard"] and {r.shard for r in out.collect()} == {"mine"}
    with pytest.raises(ValueError, match="column already"):
        S.assign(df, "doc_id", [1.0], into="Shard")
    S.write_shards(df, "doc_id", [1.0] * 4, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.shard, r._shard) for r in back.collect()} == {(r.doc_id, "mine", r._shard) for r in out.collect()}


def test_query(spark, tmp_path):
    rows = edge_rows()
    docs_frame(spark, rows, clashes=False).write.parquet(str(tmp_path / "documents.parquet"))
    out = S.op6_rendezvous_sharding(spark, str(tmp_path)).collect()
    import zlib
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", plain_shard(i, [1.0] * 16), plain_shard(i, [1.0] * 17)) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in out) == want
