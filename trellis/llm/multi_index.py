"""Near-duplicate vectors by an inverted multi-index, verified exactly.

Vectors are scaled to length one and cut into halves; a k-means codebook for each
half, learned from a bounded sample, makes a grid of k x k cells.  A vector is
stored in the cell of its nearest centroids.  To find its neighbours it visits
cells in multi-sequence order: nearest first, by the squared distance it would
have to move to fall into the cell (to the bisectors between its own centroids
and the cell's).  A neighbour at the threshold is never further than the
chord, so a traversal to the chord misses nothing; how far it goes is set on a sample
so that the target share is reached, from at least one side, of each of: the
sample's own pairs at the threshold or above, and vectors turned by exactly the
threshold's angle towards their nearest sampled vectors, towards any sampled vectors
(the directions in which the data differ), and in any direction.  The furthest of
these counts.  Everything met is verified by the cosine in double precision.

Equal vectors are one class.  A cell's members and visitors meet in blocks, so
that a hot cell spreads over tasks, and a pair counts only where the rule of
``_verify`` says.  Blocks return link counts and star edges, never links.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component, or whose id is null, links with nothing (its component is its
own id); only vectors of equal length are compared; rows that repeat an id or a
vector stay, row by row; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import map_arrow
from trellis.llm.components import connected_components, star_edges
from trellis.plans.tables import stored
from trellis.sources.tables import read_table

THRESHOLD = 0.95
RECALL = 0.999
#: Vectors that codebooks are learned from, about, chosen by their hash.
SAMPLE = 20_000
MAX_CENTROIDS = 1024
#: Sampled vectors whose pairs with the whole sample set the reach.
PROBES = 2000
#: Classes to a cell, about, while the grid may grow.
PER_CELL = 256
BLOCK_STORED = 2048
BLOCK_VISITORS = 4096


@dataclass(frozen=True)
class MultiIndex:
    first: np.ndarray          # centroids of the first halves
    second: np.ndarray
    reach: float               # squared distance that a traversal goes to

    @cached_property
    def apart(self) -> list[np.ndarray]:
        """Distances between the centroids of each half."""
        return [_distances(book, book) for book in (self.first, self.second)]

    def _moves(self, half: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid, and squared distance to the bisector with each."""
        book = (self.first, self.second)[which]
        square = (half ** 2).sum(1)[:, None] - 2 * half @ book.T + (book ** 2).sum(1)[None, :]
        own = square.argmin(axis=1)
        move = square - square[np.arange(len(half)), own][:, None]
        move /= 2 * np.maximum(self.apart[which][own], 1e-12)
        move[np.arange(len(half)), own] = 0.0
        np.maximum(move, 0.0, out=move)
        move *= move
        return own, move

    def home(self, unit: np.ndarray) -> np.ndarray:
        h = self.first.shape[1]
        a, _ = self._moves(unit[:, :h], 0)
        b, _ = self._moves(unit[:, h:], 1)
        return a * len(self.second) + b

    def visits(self, unit: np.ndarray) -> list[np.ndarray]:
        """Cells of each vector's traversal, its home first."""
        h = self.first.shape[1]
        _, first = self._moves(unit[:, :h], 0)
        _, second = self._moves(unit[:, h:], 1)
        return [multi_sequence(a, b, self.reach) for a, b in zip(first, second, strict=True)]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ y.T + (y ** 2).sum(1)[None, :], 0.0))


def multi_sequence(a: np.ndarray, b: np.ndarray, reach: float) -> np.ndarray:
    """Cells i * len(b) + j in order of a[i] + b[j], while that is at most ``reach``."""
    by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    out, heap, pushed = [], [(a[by_a[0]] + b[by_b[0]], 0, 0)], {(0, 0)}
    while heap:
        far, i, j = heapq.heappop(heap)
        if far > reach:
            break
        out.append(by_a[i] * len(b) + by_b[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in pushed:
                pushed.add((x, y))
                heapq.heappush(heap, (a[by_a[x]] + b[by_b[y]], x, y))
    return np.array(out, np.int32)


def _k_means(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    if not points.shape[1]:
        return np.zeros((1, 0))
    random = np.random.default_rng(7)
    book = points[random.choice(len(points), min(k, len(points)), replace=False)]
    book = np.unique(book, axis=0)
    for _ in range(rounds):
        near = ((book ** 2).sum(1)[None, :] - 2 * points @ book.T).argmin(axis=1)
        n = np.bincount(near, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, near, points)
        book = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], book)
    return np.unique(book, axis=0)


def fit(sample: np.ndarray, centroids: int, threshold: float = THRESHOLD, recall: float = RECALL) -> MultiIndex:
    """Codebooks and reach from unit vectors."""
    h = max(1, sample.shape[1] // 2)
    first, second = _k_means(sample[:, :h], centroids), _k_means(sample[:, h:], centroids)
    index = MultiIndex(first, second, math.inf)
    needed = max((float(np.quantile(x, recall, method="higher")) for x in _needs(index, sample, threshold) if len(x)), default=math.inf)
    return MultiIndex(first, second, min(needed, 2 - 2 * threshold) * (1 + 1e-9))


def _needs(index: MultiIndex, sample: np.ndarray, threshold: float):
    """Squared reach that finds each of several kinds of neighbours at the threshold."""
    h = index.first.shape[1]
    random = np.random.default_rng(11)
    x = sample[random.choice(len(sample), min(PROBES, len(sample)), replace=False)]

    def moves(from_, to):
        cell = index.home(to)
        at = np.arange(len(from_))
        a, b = np.divmod(cell, len(index.second))
        return index._moves(from_[:, :h], 0)[1][at, a] + index._moves(from_[:, h:], 1)[1][at, b]

    def either(a, b):
        return np.concatenate([np.minimum(moves(a[i:i + 1000], b[i:i + 1000]), moves(b[i:i + 1000], a[i:i + 1000]))
                               for i in range(0, len(a), 1000)]) if len(a) else np.zeros(0)

    def turned(towards):
        towards = towards - (towards * x).sum(1)[:, None] * x
        size = np.linalg.norm(towards, axis=1)
        ok = size > 1e-9                # no direction towards an equal or opposite vector
        return either(x[ok], threshold * x[ok] + math.sqrt(1 - threshold ** 2) * towards[ok] / size[ok][:, None])

    yield turned(random.standard_normal(x.shape))
    yield turned(sample[random.integers(len(sample), size=len(x))])
    nearest = np.zeros(len(x), np.int64)
    left, right = [], []
    for i in range(0, len(x), 250):
        close = x[i:i + 250] @ sample.T
        close[close > 1 - 1e-9] = -2    # itself and its copies
        nearest[i:i + 250] = close.argmax(axis=1)
        r, c = np.nonzero(close >= threshold)
        some = random.permutation(len(r))[:20_000]
        left.append(r[some] + i)
        right.append(c[some])
    yield turned(sample[nearest])
    left, right = np.concatenate(left), np.concatenate(right)
    some = random.permutation(len(left))[:40_000]
    yield either(x[left[some]], sample[right[some]])


def _doubles(column: pa.Array) -> list[np.ndarray | None]:
    out = []
    for v in column:
        if not v.is_valid or v.values is None or len(v.values) == 0 or v.values.null_count:
            out.append(None)
            continue
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        top = np.abs(x).max() if np.isfinite(x).all() else 0.0
        out.append(x if top > 0 else None)
    return out


def _keyed(batches):
    for batch in batches:
        found = _doubles(batch.column(1))
        ids = batch.column(0)
        ok = [x is not None and ids[i].is_valid for i, x in enumerate(found)]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if k else None
                            for x, k in zip(found, ok, strict=True)], pa.binary()),
             pa.array([len(x) if k else 0 for x, k in zip(found, ok, strict=True)], pa.int32()), batch.column(1)],
            ["vec_id", "key", "width", "vec"])


def _unit(column: pa.Array) -> np.ndarray:
    x = np.stack([v.values.to_numpy(zero_copy_only=False).astype(np.float64) for v in column])
    x /= np.abs(x).max(axis=1)[:, None]             # squares of any finite vector stay in range
    return x / np.linalg.norm(x, axis=1)[:, None]


def _assign(index):
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                cells = index.value.visits(_unit(part.column("vec")))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([int(c[0]) for c in cells], pa.int32()),
                     pa.array(cells, pa.list_(pa.int32()))], [*part.schema.names, "home", "cells"])
    return run


def _verify(threshold):
    def run(key, table):
        """Stored vectors against visitors of one block.  A pair counts where the
        visitor's key is the larger, or where the stored vector does not visit
        the visitor's home, the only other place where the two meet."""
        unit = _unit(table.column("vec").combine_chunks())
        keys = table.column("key").to_pylist()
        rank = np.empty(len(keys), np.int64)
        home = table.column("home").to_numpy()
        copies = table.column("copies").to_numpy()
        is_stored = table.column("stored").to_numpy(zero_copy_only=False).astype(bool)
        stored, visitor = np.flatnonzero(is_stored), np.flatnonzero(table.column("visits").to_numpy(zero_copy_only=False))
        out = ([], [], [], [])
        if len(stored) and len(visitor):
            _, rank = np.unique(np.array(keys, object), return_inverse=True)
            link = unit[visitor] @ unit[stored].T >= threshold
            link &= rank[visitor][:, None] != rank[stored][None, :]
            places, at = np.unique(home[visitor], return_inverse=True)
            back = np.zeros((len(stored), len(places)), bool)
            cells = table.column("cells").to_pylist()
            for i, s in enumerate(stored):
                back[i] = np.isin(places, cells[s])
            link &= ~back[:, at].T | (rank[visitor][:, None] > rank[stored][None, :])
            seen = np.zeros(len(unit), np.int64)
            weight = np.zeros(len(unit), np.int64)
            np.add.at(seen, visitor, link.sum(axis=1))
            np.add.at(seen, stored, link.sum(axis=0))
            np.add.at(weight, visitor, link @ copies[stored])
            np.add.at(weight, stored, copies[visitor] @ link)
            for i in np.flatnonzero(seen):
                for c, v in zip(out, (keys[i], None, int(seen[i]), int(weight[i])), strict=True):
                    c.append(v)
            for x, y in zip(*star_edges(link, visitor, stored), strict=True):
                if keys[x] != keys[y]:
                    for c, v in zip(out, (keys[x], keys[y], None, None), strict=True):
                        c.append(v)
        return pa.table({"key": pa.array(out[0], pa.binary()), "other": pa.array(out[1], pa.binary()),
                         "links": pa.array(out[2], pa.int64()), "weight": pa.array(out[3], pa.int64())})
    return run


def _found(classes: DataFrame, width: int, n: int, threshold: float, centroids: int | None) -> DataFrame:
    """Link counts and star edges of the classes of one vector length."""
    spark = classes.sparkSession
    own = classes.where(F.col("width") == width)
    share = min(1.0, SAMPLE / n)
    bucket = F.pmod(F.xxhash64("key"), F.lit(1_000_000))
    sample = own.select("vec") if share == 1 else own.where(bucket < int(1_000_000 * share) + 1).select("vec")
    unit = _unit(sample.toArrow().column("vec").combine_chunks())
    if centroids is None:
        centroids = min(MAX_CENTROIDS, max(1, math.ceil(math.sqrt(n / PER_CELL))))
    index = spark.sparkContext.broadcast(fit(unit, centroids, threshold))
    kind = dict(own.dtypes)["vec"]
    placed = stored(map_arrow(own.select("key", "copies", "vec"), _assign(index), f"key binary, copies long, vec {kind}, home int, cells array<int>"))
    # at most centroids squared rows
    held = placed.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count("*") / F.lit(BLOCK_STORED)).cast("int").alias("blocks"))
    visited = (placed.select(F.explode("cells").alias("cell")).groupBy("cell")
               .agg(F.ceil(F.count("*") / F.lit(BLOCK_VISITORS)).cast("int").alias("chunks")))
    cells = F.broadcast(held.join(visited, "cell"))
    rows = placed.select("*", F.explode("cells").alias("cell")).join(cells, "cell")
    rows = rows.select("*", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("own_block"),
                       F.pmod(F.xxhash64("key", F.lit(1)), F.col("chunks")).cast("int").alias("own_chunk"),
                       (F.col("cell") == F.col("home")).alias("at_home"))
    # a visitor goes to every block of the stored, a stored vector to every chunk of visitors
    visits = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(
        b.alias("block"), F.col("own_chunk").alias("chunk"), F.lit(True).alias("visits"),
        (F.col("at_home") & (b == F.col("own_block"))).alias("stored")))
    stays = F.transform(F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: c != F.col("own_chunk")),
                        lambda c: F.struct(F.col("own_block").alias("block"), c.alias("chunk"),
                                           F.lit(False).alias("visits"), F.lit(True).alias("stored")))
    both = F.concat(visits, F.when(F.col("at_home"), stays).otherwise(F.slice(stays, 1, 0)))
    dealt = rows.select("key", "copies", "vec", "home", "cell", F.when(F.col("at_home"), F.col("cells")).alias("cells"),
                        F.explode(both).alias("to"))
    return (dealt.select("key", "copies", "vec", "home", "cells", "cell", "to.block", "to.chunk", "to.visits", "to.stored")
            .groupBy("cell", "block", "chunk").applyInArrow(
                _verify(threshold), "key binary, other binary, links long, weight long"))


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding",
                    threshold: float = THRESHOLD, centroids: int | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links (other rows linked), component_id,
    kept, n_class_links (other distinct vectors linked)."""
    kind = dict(vectors.dtypes)[vec]
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).alias("vec"))
    keyed = stored(map_arrow(rows, _keyed, f"vec_id long, key binary, width int, vec {kind}"))
    classes = stored(keyed.where("key is not null").groupBy("key")
                     .agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"),
                          F.first("width").alias("width"), F.first("vec").alias("vec")))
    found = None
    for r in classes.groupBy("width").agg(F.count("*").alias("n")).collect():
        part = _found(classes, r["width"], r["n"], threshold, centroids)
        found = part if found is None else found.union(part)
    if found is None:
        out = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return out.select("*", F.lit(True).alias("kept"), F.lit(0).cast("long").alias("n_class_links"))
    found = stored(found)
    counts = found.where("other is null").groupBy("key").agg(F.sum("links").alias("links"), F.sum("weight").alias("weight"))
    linked = connected_components(found.where("other is not null"), "key", "other")
    named = linked.join(classes.select(F.col("key").alias("node"), "class_id"), "node")
    least = named.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = named.join(least, "root").select(F.col("node").alias("key"), "component_id")
    facts = stored(classes.select("key", "class_id", "copies").join(counts, "key", "left").join(named, "key", "left")
             .select("key", (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links"),
                     F.coalesce("component_id", "class_id").alias("component_id"),
                     F.coalesce("links", F.lit(0)).alias("n_class_links")))
    # both sides are plain shuffles here, so AQE splits the copies of a common vector
    return (keyed.select("vec_id", "key").join(facts, "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"),
                    F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
                    F.coalesce("n_class_links", F.lit(0)).alias("n_class_links")))


def op2_multi_index(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")).select(
        "vec_id", "n_links", "component_id", "kept", "n_class_links")
