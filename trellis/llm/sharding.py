"""Weighted rendezvous hashing of records over shards.

Every shard draws a number from each record's key; with u the draw scaled to
(0, 1), the shard with the largest ``-weight / ln(u)`` takes the record.  Only
the key, the shard's number and its weight decide, so a record's shard is the
same on every cluster and for every order of rows, and a new shard takes rows
only into itself: all other scores stay as they were.

``place`` numbers the records of each shard without gaps: records are first
counted by task and shard, and each task then continues where the tasks before
it end, so no shard, however large, gathers in one task.

Defined results: a null key is a key of its own; rows that repeat a key share
its shard and get a slot each; an empty table gives an empty result; further
columns are ignored by ``place`` and kept by ``assign``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trellis.llm.common import documents, fresh, map_arrow
from trellis.plans.tables import stored

SHARDS = 16
_SCALE = 2.0 ** -53


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 on) that takes ``key``; weights are positive."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")
    name = F.coalesce(key.cast("string"), F.lit("\x00"))
    scores = []
    for s, w in enumerate(weights):
        draw = (F.shiftrightunsigned(F.xxhash64(name, F.lit(s)), 11).cast("double") + 0.5) * _SCALE
        scores.append(F.struct((F.lit(float(w)) / -F.ln(draw)).alias("score"), F.lit(-s).alias("place")))
    return (-F.greatest(*scores)["place"]).cast("int") if len(scores) > 1 else F.lit(0)


def assign(df: DataFrame, key: str, weights: Sequence[float], into: str | None = None) -> DataFrame:
    """``df``, all columns as they are, and the shard of each row in ``into``; no shuffle.
    Without ``into`` the column is ``shard``, with underscores before it where ``df`` has
    such a column; an ``into`` that is taken is an error."""
    name = into or fresh(df, "shard")
    if name != fresh(df, name):
        raise ValueError(f"{name!r} is a column already")
    return df.select("*", shard_of(F.col(f"`{key}`"), weights).alias(name))


def place(df: DataFrame, key: str, weights: Sequence[float], *payload: Column) -> DataFrame:
    """``payload`` columns, shard, and slot: its number, gapless from 0, in the shard."""
    narrow = df.select(*payload, shard_of(F.col(f"`{key}`"), weights).alias("shard"))

    def run(batches):
        task = TaskContext.get().partitionId()
        counts = np.zeros(len(weights), np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            order = np.argsort(shard, kind="stable")
            own = np.bincount(shard, minlength=len(weights))
            nth = np.empty(len(shard), np.int64)
            nth[order] = np.arange(len(shard)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(counts, own)
            counts += own
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(shard), task, np.int32)), pa.array(nth)],
                [*batch.schema.names, "_task", "_nth"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema)
    # stored, so that the numbers counted are the numbers used
    kept = stored(map_arrow(narrow, run, f"{fields}, _task int, _nth long"))
    tally = kept.groupBy("shard", "_task").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    first = tally.select("shard", "_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    return (kept.join(first, ["shard", "_task"])
            .select(*[c for c in narrow.columns], (F.col("_first") + F.col("_nth")).alias("slot")))


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str) -> None:
    """Write ``df`` below ``path``, a folder for each shard (the column that ``assign``
    names), without a shuffle."""
    assign(df, key, weights).write.partitionBy(fresh(df, "shard")).parquet(path)


def op6_rendezvous_sharding(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    utf8 = F.coalesce(F.col("text"), F.lit(""))
    out = place(docs, "doc_id", [1.0] * SHARDS, F.col("doc_id"),
                (F.octet_length(utf8) + 1).cast("long").alias("size"),
                F.crc32(utf8.cast("binary")).alias("text_crc32"),
                shard_of(F.col("doc_id"), [1.0] * (SHARDS + 1)).alias("grown_shard"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
