"""A file catalog as a table that several writers insert into (F7 sink).

A commit is a batch of inserts under an id that the writer chooses:

1. the batch is judged against the newest version (``classify_inserts``);
2. accepted and rejected rows are staged in a folder that no reader lists;
3. the commit is published by renaming a manifest to the next version number,
   which fails where that number is taken.

The manifest's rename is the only step that others see, so a writer that dies
leaves at most a folder that nobody reads.  A writer that finds its number taken
judges its batch anew against the version that took it: of two batches that name
one node, the first to publish has it and the other's row is rejected, as if the
batches had come one after the other.  A batch whose id is already published
(a retry, a replayed micro-batch) changes nothing and gets the first outcome.

A version never changes: ``files(version)`` reads the same rows for ever, which is
what a stream needs to serve a micro-batch again.  Manifests are one line each; a
version is read from the list of them, the rows by Spark.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.operators.catalog import add_files
from trellis.plans.tables import stored
from trellis.session import create_once, delete_dir

CATALOG_SCHEMA = "path string, contents string"
REJECTED_SCHEMA = "seq bigint, path string, reason string"
MANIFEST_SCHEMA = "version bigint, batch_id string, folder string, accepted bigint, rejected bigint"
ATTEMPTS = 20


@dataclass(frozen=True)
class Commit:
    """One published batch: its version, and where its rows are."""

    version: int
    batch_id: str
    folder: str
    accepted: int
    rejected: int


class CatalogTable:
    """A catalog folder: ``log/`` (manifests) and ``data/`` (one folder a commit)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        if not create_once(spark, f"{self.path}/log/{0:020d}.json", json.dumps({"version": 0}) + "\n"):
            pass                                    # another writer made the table

    def commits(self) -> list[Commit]:
        """Published commits in order of their version."""
        rows = (self.spark.read.schema(MANIFEST_SCHEMA).option("pathGlobFilter", "*.json")
                .json(f"{self.path}/log").where("batch_id is not null").collect())
        return sorted((Commit(**r.asDict()) for r in rows), key=lambda c: c.version)

    def version(self) -> int:
        """The newest version; 0 is the empty catalog."""
        return max((c.version for c in self.commits()), default=0)

    def _read(self, commits: list[Commit], kind: str, schema: str) -> DataFrame:
        folders = [f"{self.path}/{c.folder}/{kind}" for c in commits]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def files(self, version: int | None = None, after: int = 0) -> DataFrame:
        """``(path, contents)`` of a version (the newest by default), or only what came
        ``after`` an earlier one.  Every node is named once."""
        return self._read([c for c in self.commits() if after < c.version and (version is None or c.version <= version)],
                          "accepted", CATALOG_SCHEMA)

    def rejected(self, batch_id: str) -> DataFrame:
        """The dead letters ``(seq, path, reason)`` of a published batch."""
        return self._read([c for c in self.commits() if c.batch_id == batch_id], "rejected", REJECTED_SCHEMA)

    def insert(self, batch: DataFrame, batch_id: str, before_publish=None) -> Commit:
        """Publish ``batch(seq, path, contents)`` once under ``batch_id``.

        ``before_publish`` is called between staging and publishing (tests put another
        writer there)."""
        batch = stored(batch.select("seq", "path", "contents"))
        for _ in range(ATTEMPTS):
            commits = self.commits()
            done = next((c for c in commits if c.batch_id == batch_id), None)
            if done:
                return done
            accepted, rejected = add_files(self._read(commits, "accepted", CATALOG_SCHEMA), batch)
            folder = f"data/{uuid.uuid4().hex}"
            accepted.write.parquet(f"{self.path}/{folder}/accepted")
            rejected.write.parquet(f"{self.path}/{folder}/rejected")
            if before_publish:
                before_publish()
            version = max((c.version for c in commits), default=0) + 1
            n = [self.spark.read.parquet(f"{self.path}/{folder}/{kind}").count() for kind in ("accepted", "rejected")]
            commit = Commit(version, batch_id, folder, *n)
            if create_once(self.spark, f"{self.path}/log/{version:020d}.json", json.dumps(commit.__dict__) + "\n"):
                return commit
            delete_dir(self.spark, f"{self.path}/{folder}")
        raise RuntimeError(f"batch {batch_id!r} met another commit {ATTEMPTS} times")


def insert_stream(batches: DataFrame, table: CatalogTable, checkpoint_dir: str, name: str, available_now: bool = False):
    """Every micro-batch of ``(seq, path, contents)`` becomes one commit ``<name>-<batch>``;
    a micro-batch that is run again after a failure is found published."""
    def put(batch: DataFrame, batch_id: int) -> None:
        table.insert(batch, f"{name}-{batch_id}")

    writer = batches.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def nodes_per_name(files: DataFrame) -> DataFrame:
    """``(path, n)`` of names that more than one row holds: none in a catalog table."""
    return files.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
