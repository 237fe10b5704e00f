"""File catalog operators: a folder tree held as a table of file paths.

The reference keeps an in-memory tree of folder objects.  Here the tree is
implied by ``files(path, contents)``: folders are the strict prefixes of file
paths, and every lookup is an equi-join on canonical path keys (see
``trellis.functions.paths``).  Hot folders are handled by map-side partial
aggregation (``distinct`` / ``min`` on exploded prefixes) and by AQE's
skew-join splitting; no group is ever collected.

A tree has one node per name: where several catalog rows name the same file,
the row with the smallest path, then the smallest contents, stands for it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.session import ensure_checkpoint_dir
from trellis.functions.paths import (ROOT_NAME, is_absolute, key_depth, key_name, key_parent, key_prefix,
                                     key_prefix_lengths, key_under_root, path_key)

ROOT_KEY = "/" + ROOT_NAME

REASONS = ("no_seq", "repeated_seq", "not_absolute", "wrong_root", "root_only", "duplicate", "is_folder",
           "parent_is_file")


def _named(files: DataFrame, *columns) -> DataFrame:
    """``key`` and ``columns`` of every valid catalog row (repeats included)."""
    return files.select(path_key("path").alias("key"), *columns).where(F.col("key").startswith(ROOT_KEY + "/"))


def file_keys(files: DataFrame) -> DataFrame:
    """``key`` of every file, each once; reads no contents."""
    return _named(files).distinct()


def file_nodes(files: DataFrame) -> DataFrame:
    """``(key, contents)``: one row per file of a catalog.  A hot name is
    combined map-side."""
    return (_named(files, "path", "contents").groupBy("key")
            .agg(F.min(F.struct("path", "contents")).alias("first"))
            .select("key", F.col("first.contents").alias("contents")))


def folder_tree(files: DataFrame) -> DataFrame:
    """F8: ``(folder, depth)`` for every folder implied by a file, each once;
    the root is always present."""
    folders = (_named(files).select(F.explode(key_prefix_lengths("key")).alias("depth"), "key")
               .select(key_prefix("key", F.col("depth")).alias("folder"), "depth"))
    root = files.sparkSession.createDataFrame([(ROOT_KEY, 1)], "folder string, depth int")
    return folders.unionByName(root).distinct()


def list_children(files: DataFrame) -> DataFrame:
    """``(parent, name, kind)``: direct children of each folder."""
    keys = _named(files)
    file_rows = keys.select(key_parent("key").alias("parent"), key_name("key").alias("name"), F.lit("file").alias("kind"))
    sub = (keys.select(F.explode(key_prefix_lengths("key", 2)).alias("n"), "key")
           .select(key_prefix("key", F.col("n") - 1).alias("parent"),
                   key_name(key_prefix("key", F.col("n"))).alias("name"), F.lit("folder").alias("kind")))
    return file_rows.unionByName(sub).distinct()


def has_child(children: DataFrame, probe: DataFrame) -> DataFrame:
    """for each probe ``(parent, name)`` (parent given as a path), whether
    the folder holds a child of that name."""
    keyed = probe.select("parent", "name", path_key("parent").alias("_pk"))
    hits = (children.select(F.col("parent").alias("_pk"), "name").distinct()
            .withColumn("_hit", F.lit(True)))
    return (keyed.join(hits, ["_pk", "name"], "left")
            .select("parent", "name", F.coalesce("_hit", F.lit(False)).alias("found")))


def keyed_files(files: DataFrame) -> DataFrame:
    """``(_key, contents)``: the lookup side of F11, unique on ``_key``."""
    return file_nodes(files).select(F.col("key").alias("_key"), "contents")


def read_files(files: DataFrame, wanted: DataFrame, path_col: str = "path",
               keyed: DataFrame | list[DataFrame] | None = None) -> DataFrame:
    """every wanted row, once, plus ``contents``; NULL when the path is
    missing, a folder, below a file, outside the root or not absolute.

    ``keyed`` may hold a prepared lookup side (``keyed_files`` output, e.g.
    broadcast or bucketed on ``_key``), which is then used instead of
    ``files``; or a list of them that have no key in common.
    """
    nodes = keyed if keyed is not None else keyed_files(files)
    out = wanted.withColumn("_key", path_key(path_col))
    if not isinstance(nodes, list):
        return out.join(nodes, "_key", "left").drop("_key")
    for k, part in enumerate(nodes):
        out = out.join(part.select("_key", F.col("contents").alias(f"_c{k}")), "_key", "left")
    found = F.coalesce(*[F.col(f"_c{k}") for k in range(len(nodes))]) if nodes else F.lit(None).cast("string")
    return out.select(*wanted.columns, found.alias("contents"))


def node_kinds(files: DataFrame) -> DataFrame:
    """``(key, is_file, is_folder)`` for every tree node, from one pass over
    the catalog: each file yields its own key and every strict prefix."""
    lengths = F.concat(key_prefix_lengths("key"), F.array(key_depth("key")))
    rows = (_named(files).select("key", key_depth("key").alias("depth"), F.explode(lengths).alias("n"))
            .select(key_prefix("key", F.col("n")).alias("key"), (F.col("n") == F.col("depth")).cast("int").alias("f")))
    return (rows.groupBy("key").agg((F.max("f") == 1).alias("is_file"), (F.min("f") == 0).alias("is_folder")))


def path_kind(files: DataFrame, wanted: DataFrame, path_col: str = "path") -> DataFrame:
    """every wanted row plus ``kind``: ``file``, ``folder``, ``below_file``,
    ``missing``, ``outside_root`` (or ``not_absolute``).

    Each distinct wanted key below the root is exploded into itself and its
    strict prefixes, which meet the node flags in one join; the flags found
    are combined per key and joined back, so a hot path costs one row of work.
    """
    keyed = wanted.withColumn("_key", path_key(path_col))
    keys = keyed.where(key_under_root("_key")).select("_key").distinct()
    lengths = F.concat(key_prefix_lengths("_key", 2), F.array(key_depth("_key")))
    steps = (keys.select("_key", key_depth("_key").alias("depth"), F.explode(lengths).alias("n"))
             .select("_key", key_prefix("_key", F.col("n")).alias("key"), (F.col("n") == F.col("depth")).alias("own")))
    found = steps.join(node_kinds(files), "key", "left")
    own = F.col("own")
    kinds = (found.groupBy("_key").agg(
        F.max(own & F.coalesce("is_file", F.lit(False))).alias("file"),
        F.max(own & F.coalesce("is_folder", F.lit(False))).alias("folder"),
        F.max(~own & F.coalesce("is_file", F.lit(False))).alias("below"))
        .select("_key", F.when(F.col("file"), "file").when(F.col("folder") | (F.col("_key") == ROOT_KEY), "folder")
                .when(F.col("below"), "below_file").otherwise("missing").alias("_kind")))
    final = (F.when(~is_absolute(path_col), "not_absolute").when(~key_under_root("_key"), "outside_root")
             .otherwise(F.col("_kind")))
    return keyed.join(kinds, "_key", "left").select(*wanted.columns, final.alias("kind"))


def classify_inserts(catalog: DataFrame, batch: DataFrame) -> DataFrame:
    """F7 verdicts: every batch row ``(seq, path, contents)`` plus ``verdict``
    (``accepted`` or one of ``REASONS``).

    A row without a ``seq`` has no place in the order and rows that share one
    have no order among themselves: both are rejected (``no_seq``,
    ``repeated_seq``).  The others are not negative and apply in ``seq`` order
    after the existing catalog, insert-only.
    A valid row P is rejected when (c) an earlier row A is a strict ancestor
    of P and no row before A lies under A (``parent_is_file``); otherwise
    when an earlier row equals P or lies under P, the first such row decides
    (``duplicate`` / ``is_folder``).  A failed insert creates nothing, so the
    rule needs no recursion: a handful of joins on exploded prefix keys.

    Runs eagerly: the verdicts are checkpointed (into ``spark.checkpoint.dir``)
    and the intermediate tables released; the returned frame joins them back
    to the batch lazily.
    """
    pre = (F.when(~is_absolute("path"), "not_absolute")
           .when(~key_under_root("key"), "wrong_root")
           .when(key_depth("key") < 2, "root_only"))
    # only rows that a seq names are judged; normalised once, reused below
    named = batch.where(F.col("seq").isNotNull()).select(F.col("seq").cast("bigint").alias("seq"), "path")
    single = named.groupBy("seq").agg(F.count("*").alias("n"), F.min("path").alias("path")).where("n = 1")
    b = (single.select("seq", "path", path_key("path").alias("key"))
         .withColumn("pre", pre).persist(StorageLevel.MEMORY_AND_DISK))
    cat = _named(catalog).select(F.lit(-1).cast("bigint").alias("seq"), "key").distinct()
    valid_batch = b.where(F.col("pre").isNull()).select("seq", "key")
    rows = cat.unionByName(valid_batch).persist(StorageLevel.MEMORY_AND_DISK)
    anc = (rows.select("seq", "key", F.explode(key_prefix_lengths("key", 2)).alias("n"))
           .select("seq", "key", key_prefix("key", F.col("n")).alias("pkey"))
           .persist(StorageLevel.MEMORY_AND_DISK))
    min_under = anc.groupBy(F.col("pkey").alias("key")).agg(F.min("seq").alias("min_under"))
    min_same = rows.groupBy("key").agg(F.min("seq").alias("min_same"))
    firsts = min_same.join(min_under, "key", "left")
    cand = (firsts.where(F.col("min_under").isNull() | (F.col("min_same") < F.col("min_under")))
            .select(F.col("key").alias("pkey"), F.col("min_same").alias("cand")))
    parent_file = (anc.join(cand, "pkey").where(F.col("cand") < F.col("seq"))
                   .select("seq", "key").distinct().withColumn("pf", F.lit(True)))
    judged = (valid_batch.join(firsts, "key", "left")
              .join(parent_file, ["seq", "key"], "left"))
    big = F.lit(None).cast("bigint")
    e_same = F.when(F.col("min_same") < F.col("seq"), F.col("min_same")).otherwise(big)
    e_under = F.when(F.col("min_under") < F.col("seq"), F.col("min_under")).otherwise(big)
    verdict = (F.when(F.col("pf"), "parent_is_file")
               .when(e_same.isNotNull() & (e_under.isNull() | (e_same < e_under)), "duplicate")
               .when(e_under.isNotNull(), "is_folder")
               .otherwise("accepted"))
    v = judged.select("seq", "key", verdict.alias("verdict"))
    out = b.join(v.select("seq", "verdict"), "seq", "left")
    verdicts = out.select("seq", F.coalesce("pre", "verdict").alias("verdict"))
    # materialise the small (seq, verdict) table in the checkpoint folder,
    # then release the intermediate tables it was computed from
    ensure_checkpoint_dir(batch.sparkSession)
    verdicts = verdicts.checkpoint(eager=True)
    for cached in (anc, rows, b):
        cached.unpersist()
    verdict = (F.when(F.col("seq").isNull(), "no_seq")
               .otherwise(F.coalesce("verdict", F.lit("repeated_seq"))))
    return batch.join(verdicts, "seq", "left").select("seq", "path", "contents", verdict.alias("verdict"))


def add_files(catalog: DataFrame, batch: DataFrame) -> tuple:
    """``(accepted, rejected)``.

    ``accepted(path, contents)`` is what an insert-only sink appends (see
    ``append_files``); ``rejected(seq, path, reason)`` is a dead-letter table.
    """
    verdicts = classify_inserts(catalog, batch)
    accepted = verdicts.where(F.col("verdict") == "accepted").select("path", "contents")
    rejected = verdicts.where(F.col("verdict") != "accepted").select(
        "seq", "path", F.col("verdict").alias("reason"))
    return accepted, rejected


def append_files(accepted: DataFrame, table_path: str) -> None:
    """F7 sink for one writer: append accepted files to a parquet folder; never
    overwrites.  ``trellis.sources.catalog_log`` is the sink for several writers, and for
    batches that may be repeated.

    Rows whose node the table already holds are left out (keys only are
    compared), so appending the same files again changes nothing.
    """
    spark = accepted.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(table_path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        held = file_keys(spark.read.parquet(table_path)).select(F.col("key").alias("_key"))
        accepted = (accepted.withColumn("_key", path_key("path"))
                    .join(held, "_key", "left_anti").drop("_key"))
    accepted.write.mode("append").parquet(table_path)
