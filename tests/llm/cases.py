"""Shared rows: nulls, empty and long texts, ties, repeated rows, extra columns."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Names that operators use inside or return, as further columns of a table.
CLASHES = ["kept", "key", "n", "shard", "slot", "node", "group", "length", "score", "_words", "_row", "_rows", "_rows_id",
           "task", "nth", "sequence_id", "lang_pred", "set", "vec", "payload"]


def docs_frame(spark, rows, clashes=True):
    """A documents table of (doc_id, text[, lang]) rows, with clashing columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashes:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    return df


def words(seed, n, size=6):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, size))) for _ in range(n)]


def prose(seed, n):
    return " ".join(words(seed, n))


def edge_rows():
    long = prose(99, 30_000)
    return [(1, prose(1, 120)), (2, None), (3, ""), (4, " \t\n\x0b\f\r "), (5, long), (6, prose(1, 120)), (7, "one two"),
            (None, prose(7, 60)), (8, prose(8, 80)), (8, prose(8, 80)), (9, "日本語 テキスト \U0001f600 é"), (10, "a b c")]
