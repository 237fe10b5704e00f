"""N-gram Jaccard self-join by MinHash LSH prefixes with exact verification.

1. Texts with the same set of shingles (five words) are one class; everything
   below works on one representative of each class.
2. A signature is a forest's paths: ``TREES`` paths of ``DEPTH`` labels.  A trie node is the
   classes whose paths begin alike.  A tree's subtries below ``LEAST`` labels, the shortest
   prefix that may be matched, are laid side by side, each sorted by path; one that a
   single class has is left out.  ``LEAST`` is the longest prefix with which the forest
   finds a pair at the threshold with a chance of ``RECALL``.
3. All trees in step, prefixes are shortened from their full length.  A class's own
   partners tell when to stop: from the signatures, ``likely`` partners are counted by the
   longest prefix that they share with it in any tree, and its prefixes are
   shortened until those still unmatched are at most a share of 1 - ``RECALL``.  A class
   whose likely partners all share full paths (a large group of near copies) stops there;
   one without any goes down to ``LEAST``.  A pair is tried if it is matched for either side.
4. A pair is tried in one place: the first tree in which it shares a subtrie.  Only
   classes that have such a pair there send their sets, which are compared exactly, block
   by block (hashed members within bands of set size; bands too far apart to reach the
   threshold never meet).  So work follows the pairs that share a prefix: texts that are
   alike only through others in between never meet.  Blocks return link counts and a
   spanning forest of the links, never the links.

The forest decides which pairs are tried (a pair at exactly the threshold is missed with a
chance of about 1 - RECALL, more alike ones far more rarely); the link itself is exact but
for collisions of 64-bit shingle hashes.

Defined results: a null, empty or blank text has no shingles, its document is a
class of its own and links with nothing; a text of one to four words has one
shingle; ids may be null or repeated, rows with equal sets (repeated rows too)
are copies; ids of a class or group are the smallest non-null ones; the class
that stands for a group is the one with the smallest id (null last, then the
smallest key); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from trellis.llm.common import column_bytes, documents, fresh, map_arrow, mix64, shingles, text_slices
from trellis.llm.components import connected_components, star_edges
from trellis.plans.sizing import BROADCAST_ROW_LIMIT, at_most
from trellis.plans.tables import stored

WIDTH = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 8
RECALL = 0.995
#: Share of equal labels from which a pair counts as likely: over four standard
#: deviations of 128 labels below the threshold.
LIKELY = 0.65
#: Verification works on blocks of about so many sets and shingles.
BLOCK_SETS = 256
BLOCK_SHINGLES = 1_000_000
#: Pairs whose signatures are compared at a time.
PAIRS = 1 << 15
#: Sets are made of about so many text bytes at a time, which bounds their arrays.
SET_BYTES = 1 << 20


def recall_at(depth: int, threshold: float = THRESHOLD, trees: int = TREES) -> float:
    return 1 - (1 - threshold ** depth) ** trees


def least_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix, of at most ``depth`` labels, with which the forest finds a
    pair at the threshold with the target recall; shorter ones are never needed."""
    while depth > 1 and recall_at(depth, threshold, trees) < recall:
        depth -= 1
    return depth


def text_sets(batch: pa.RecordBatch, index: int, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted shingle set of every text."""
    data, offsets = column_bytes(batch.column(index))
    found, at = shingles(data, offsets, width)
    return [np.unique(found[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


_SEEDS = mix64(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64))


LEAST = least_depth()


def labels(own: np.ndarray) -> np.ndarray:
    """TREES x DEPTH trie labels: the least of each permutation, mixed to 16 bits."""
    out = np.full(len(_SEEDS), np.uint64(0xFFFFFFFFFFFFFFFF))
    with np.errstate(over="ignore"):
        step = max(1, (1 << 18) // len(_SEEDS))
        for a in range(0, len(own), step):
            x = own[a:a + step, None] ^ _SEEDS[None, :]
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0x94D049BB133111EB)
            np.minimum(out, x.min(axis=0), out=out)
    return (mix64(out) >> np.uint64(48)).astype(">u2").reshape(TREES, DEPTH)


def _signatures(batches):
    """id, class key, set size and paths (big-endian labels, so that they sort as bytes)."""
    for batch in batches:
        for part in text_slices(batch, 1, SET_BYTES):
            sets = text_sets(part, 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([_digest(x) if len(x) else None for x in sets], pa.binary()),
                 pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([labels(x).tobytes() if len(x) else None for x in sets], pa.binary())],
                ["doc_id", "key", "n", "paths"])


def _members(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def subtries(classes: DataFrame) -> DataFrame:
    """(key, n, tree, group): each class in each tree, where another class shares its
    first ``LEAST`` labels; ``group`` names the subtrie."""
    prefix = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)),
                         lambda t: F.substring(F.col("paths"), 2 * DEPTH * t + 1, F.lit(2 * LEAST)))
    rows = classes.select("key", "n", F.posexplode(prefix).alias("tree", "prefix"))
    rows = rows.select("key", "n", "tree", F.xxhash64("tree", "prefix").alias("group"))
    shared = rows.groupBy("group").agg(F.count("*").alias("m")).where("m > 1").select("group")
    return rows.join(shared, "group")


def _dealt(groups: DataFrame) -> DataFrame:
    """Blocks of each member: band (of set sizes a threshold apart) and block;
    then one row for every pair of blocks that the member takes part in."""
    band = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(THRESHOLD))).cast("int")
    placed = groups.withColumn("band", band)
    blocks = placed.groupBy("group", "band").agg(
        F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_SETS)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES))).cast("int").alias("blocks"))
    near = blocks.select("group", "band", F.create_map(F.lit(0), "blocks").alias("own"))
    for step in (-1, 1):
        other = blocks.select("group", (F.col("band") - step).alias("band"), F.col("blocks").alias(f"b{step + 1}"))
        near = near.join(other, ["group", "band"], "left")
    near = near.select("group", "band", F.element_at("own", 0).alias("blocks"),
                       F.coalesce("b0", F.lit(0)).alias("below"), F.coalesce("b2", F.lit(0)).alias("above"))
    own = placed.join(near, ["group", "band"]).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))

    def pairs(band_a, band_b, count, ours_first):
        other = F.sequence(F.lit(0), count - 1)
        return F.when(count > 0, F.transform(other, lambda o: F.struct(
            band_a.alias("band_a"), (F.col("block") if ours_first else o).alias("block_a"),
            band_b.alias("band_b"), (o if ours_first else F.col("block")).alias("block_b")))).otherwise(F.array())

    same = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.col("band").alias("band_a"), F.least("block", o).alias("block_a"),
        F.col("band").alias("band_b"), F.greatest("block", o).alias("block_b")))
    both = F.concat(same, pairs(F.col("band"), F.col("band") + 1, F.col("above"), True),
                    pairs(F.col("band") - 1, F.col("band"), F.col("below"), False))
    return own.select("key", "tree", "group", "band", "block", F.explode(both).alias("pair"))


_PLACE = ["group", "band_a", "block_a", "band_b", "block_b"]


def whole_groups(batches, names):
    """Tables that hold whole groups of rows, from batches sorted by ``names``."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if not table.num_rows:
            continue
        last = np.ones(table.num_rows, bool)
        for c in names:
            x = table.column(c).to_numpy()
            last &= x == x[-1]
        cut = int(np.argmax(last))
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


@lru_cache(maxsize=512)
def _triangle(m: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(m, 1)


def _group_pairs(table: pa.Table):
    """For each group of a table: its first row and end, and the row pairs that meet
    in it: within one block, or of the left and the right block."""
    cols = {c: table.column(c).to_numpy() for c in [*_PLACE, "band", "block"]}
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for c in _PLACE:
        change[1:] |= cols[c][1:] != cols[c][:-1]
    starts = [*np.flatnonzero(change).tolist(), table.num_rows]
    alike = (cols["band_a"] == cols["band_b"]) & (cols["block_a"] == cols["block_b"])
    left = (cols["band"] == cols["band_a"]) & (cols["block"] == cols["block_a"])
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a < 2:
            continue
        if alike[a]:
            i, j = _triangle(b - a) if b - a < 300 else np.triu_indices(b - a, 1)
            yield a, b, i + a, j + a
        else:
            x, y = np.flatnonzero(left[a:b]) + a, np.flatnonzero(~left[a:b]) + a
            yield a, b, np.repeat(x, len(y)), np.tile(y, len(x))


def _paths_of(table: pa.Table) -> np.ndarray:
    """Rows x trees x labels."""
    return np.frombuffer(b"".join(table.column("paths").to_pylist()), ">u2").astype(np.uint16).reshape(-1, TREES, DEPTH)


def starts_of(paths: np.ndarray) -> np.ndarray:
    """Rows x trees: a 64-bit hash of the first ``LEAST`` labels."""
    out = np.zeros(paths.shape[:2], np.uint64)
    with np.errstate(over="ignore"):
        for d in range(LEAST):
            out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + paths[:, :, d])
    return out


def met_here(starts: np.ndarray, tree: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which row pairs share no subtrie in a tree before that of their place."""
    out = np.empty(len(i), bool)
    for a in range(0, len(i), PAIRS):
        x, y = i[a:a + PAIRS], j[a:a + PAIRS]
        same = starts[x] == starts[y]
        out[a:a + PAIRS] = same.any(axis=1) & (same.argmax(axis=1) == tree[x])
    return out


def match(paths: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For row pairs: the longest prefix that they share in any tree, and their number of
    equal labels."""
    longest, equal = np.empty(len(i), np.int64), np.empty(len(i), np.int64)
    for a in range(0, len(i), PAIRS):
        same = paths[i[a:a + PAIRS]] == paths[j[a:a + PAIRS]]
        equal[a:a + PAIRS] = same.sum(axis=(1, 2))
        longest[a:a + PAIRS] = np.logical_and.accumulate(same, axis=2).sum(axis=2).max(axis=1)
    return longest, equal


def _batched(table: pa.Table):
    """The pairs of many small groups at a time: (group numbers' rows, i, j)."""
    i, j, n = [], [], 0
    for _, _, x, y in _group_pairs(table):
        i.append(x)
        j.append(y)
        n += len(x)
        if n >= PAIRS:
            yield np.concatenate(i), np.concatenate(j)
            i, j, n = [], [], 0
    if n:
        yield np.concatenate(i), np.concatenate(j)


def _prospects(batches):
    """Rows of signatures, by place: whether the class has a pair to try there, and its
    likely partners by the longest prefix shared (f of LEAST to DEPTH labels or more)."""
    depths = range(LEAST, DEPTH + 1)
    for table in whole_groups(batches, _PLACE):
        paths, tree = _paths_of(table), table.column("tree").to_numpy()
        starts = starts_of(paths)
        here = np.zeros(len(paths), bool)
        found = np.zeros((len(depths), len(paths)), np.int64)
        for i, j in _batched(table):
            own = met_here(starts, tree, i, j)
            i, j = i[own], j[own]
            longest, equal = match(paths, i, j)
            likely = equal >= LIKELY * TREES * DEPTH
            here[i] = here[j] = True
            for d, row in zip(depths, found, strict=True):
                at = likely & (longest >= d)
                row += np.bincount(i[at], minlength=len(paths)) + np.bincount(j[at], minlength=len(paths))
        rows = table.filter(pa.array(here)).drop_columns(["paths"])
        yield from rows.append_column("found", pa.array(list(found[:, here].T), pa.list_(pa.int64()))).to_batches()


def stop_depth(found: list[int], recall: float = RECALL) -> int:
    """The longest prefix length at which likely partners still unmatched are at most a
    share of 1 - recall; ``found`` counts those matched at LEAST to DEPTH labels."""
    for d in range(DEPTH, LEAST, -1):
        if found[0] and found[d - LEAST] >= recall * found[0]:
            return d
    return LEAST


def _stop(found):
    """``stop_depth`` as a Column of the summed counts."""
    depth = F.lit(LEAST)
    for d in range(LEAST + 1, DEPTH + 1):
        depth = F.when((found[0] > 0) & (found[d - LEAST] >= RECALL * found[0]), d).otherwise(depth)
    return depth


class _Sets:
    """The sets of a group's rows, all values of some of them in one sorted table."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets

    def common(self, i: int, columns: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of set ``i`` with those of ``columns``."""
        own = self.sets[i]
        if len(columns) < 48:
            out = np.empty(len(columns), np.int64)
            for k, j in enumerate(columns.tolist()):
                at = np.searchsorted(self.sets[j], own)
                at[at == len(self.sets[j])] = 0
                out[k] = np.count_nonzero(self.sets[j][at] == own)
            return out
        if not hasattr(self, "values"):
            values = np.concatenate(self.sets)
            owner = np.repeat(np.arange(len(self.sets)), [len(x) for x in self.sets])
            order = np.argsort(values, kind="stable")
            self.values, self.owner = values[order], owner[order]
        a = np.searchsorted(self.values, own, side="left")
        n = np.searchsorted(self.values, own, side="right") - a
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.owner[at], minlength=len(self.sets))[columns]


def _verify(batches):
    """Links of the pairs that are matched: (key, other, links, weight): link counts with
    other null, and connecting edges with links null."""
    for table in whole_groups(batches, _PLACE):
        paths, tree, depth = _paths_of(table), table.column("tree").to_numpy(), table.column("depth").to_numpy()
        keys, copies = table.column("key").to_pylist(), table.column("copies").to_numpy()
        size, starts = table.column("n").to_numpy(), starts_of(paths)
        bytes_of = table.column("set")
        links, weight = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        edges = ([], [])
        for a, b, i, j in _group_pairs(table):
            own = met_here(starts, tree, i, j)
            i, j = i[own], j[own]
            tried = match(paths, i, j)[0] >= np.minimum(depth[i], depth[j])
            i, j = i[tried], j[tried]
            if not len(i):
                continue
            sets = _Sets([np.frombuffer(bytes_of[k].as_py(), np.uint64) for k in range(a, b)])
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            linked = np.zeros((b - a, b - a), bool)
            cuts = [*np.flatnonzero(np.diff(i, prepend=-1)).tolist(), len(i)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                row, columns = i[x], j[x:y]
                both = sets.common(row - a, columns - a)
                union = size[row] + size[columns] - both
                ok = both * 5 >= union * 4 if THRESHOLD == 0.8 else both >= THRESHOLD * union
                linked[row - a, columns[ok] - a] = True
            own = np.arange(a, b)
            links[a:b] += linked.sum(axis=1) + linked.sum(axis=0)
            weight[a:b] += linked @ copies[a:b] + copies[a:b] @ linked
            for x, y in zip(*star_edges(linked | linked.T, own, own), strict=True):
                edges[0].append(keys[x])
                edges[1].append(keys[y])
        some = np.flatnonzero(links).tolist()
        none = [None] * len(edges[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([keys[k] for k in some] + edges[0], pa.binary()), pa.array([None] * len(some) + edges[1], pa.binary()),
             pa.array(links[some].tolist() + none, pa.int64()), pa.array(weight[some].tolist() + none, pa.int64())],
            ["key", "other", "links", "weight"])


def _by_place(df: DataFrame) -> DataFrame:
    """Rows of a place together and in order of their paths in its tree."""
    path = F.expr(f"substring(paths, {2 * DEPTH} * tree + 1, {2 * DEPTH})")
    return df.repartition(*_PLACE).sortWithinPartitions(*_PLACE, path)


def _judged(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key) of every document and the facts of every class: key,
    class_id, copies, n_links, n_class_links, group_id, stands (for its group)."""
    kind = dict(docs.dtypes)[doc_id]
    signed = stored(map_arrow(_members(docs, text, doc_id), _signatures, f"doc_id {kind}, key binary, n long, paths binary"))
    members = signed.select("doc_id", "key")
    classes = stored(signed.where("key is not null").groupBy("key")
                     .agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"), F.max("n").alias("n"),
                          F.first("paths").alias("paths")))
    dealt = _dealt(stored(subtries(classes)))
    place = ["key", "tree", "group", "band", "block", *[f"pair.{c}" for c in _PLACE[1:]]]
    dealt = dealt.select(*place).join(classes.select("key", "paths"), "key")
    fields = "key binary, tree int, group long, band int, block int, band_a int, block_a int, band_b int, block_b int"
    prospects = stored(map_arrow(_by_place(dealt), _prospects, f"{fields}, found array<long>"))
    depths = range(DEPTH - LEAST + 1)
    partners = prospects.groupBy("key").agg(*[F.sum(F.col("found")[d]).alias(f"f{d}") for d in depths])
    partners = partners.select("key", _stop([F.col(f"f{d}") for d in depths]).alias("depth"))
    wanted = stored(partners.join(classes, "key"))
    # texts of the candidates, one for each class, read again
    named = wanted.select("class_id").distinct()       # null where a class has no other id
    if wanted.count() <= BROADCAST_ROW_LIMIT:
        named = F.broadcast(named)                      # else both sides are shuffled
    texts = _members(docs, text, doc_id).join(named, F.col("doc_id").eqNullSafe(F.col("class_id")), "left_semi").select("text")
    texts = map_arrow(texts, _keyed_sets, "key binary, set binary").dropDuplicates(["key"])
    sized = wanted.select("key", "depth", "copies", "n", "paths").join(texts, "key")
    found = stored(map_arrow(_by_place(prospects.drop("found").join(sized, "key")), _verify,
                             "key binary, other binary, links long, weight long"))
    counts = found.where("other is null").groupBy("key").agg(F.sum("links").alias("links"), F.sum("weight").alias("weight"))
    linked = connected_components(found.where("other is not null"), "key", "other")
    members_of = linked.join(classes.select(F.col("key").alias("node"), "class_id"), "node")
    first = F.min(F.struct(F.col("class_id").isNull(), "class_id", F.col("node").alias("key"))).alias("first")
    least = members_of.groupBy("root").agg(first)
    grouped = members_of.join(least, "root").select(
        F.col("node").alias("key"), F.col("first.class_id").alias("group_id"), (F.col("node") == F.col("first.key")).alias("stands"))
    facts = stored(classes.select("key", "class_id", "copies").join(counts, "key", "left").join(grouped, "key", "left")
             .select("key", "class_id", "copies", (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links"),
                     F.coalesce("links", F.lit(0)).alias("n_class_links"),
                     F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("stands", F.lit(True)).alias("stands")))
    return members, facts


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, class_id (smallest id with the same shingle
    set), n_links (other documents at the threshold or above, copies of the
    same set included), n_class_links (other classes linked), group_id (smallest
    id reachable by links), kept (the class and id that stand for the group; rows
    that repeat both are all marked)."""
    members, facts = _judged(docs, text, doc_id)
    # both sides are plain shuffles here, so AQE splits the copies of a common text
    return (members.join(facts, "key", "left")
            .select("doc_id", F.coalesce("class_id", F.when(F.col("key").isNull(), F.col("doc_id"))).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("n_class_links", F.lit(0)).alias("n_class_links"),
                    F.coalesce("group_id", F.when(F.col("key").isNull(), F.col("doc_id"))).alias("group_id"),
                    (F.col("key").isNull() | (F.col("stands") & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("kept")))


def _keyed_sets(batches):
    for batch in batches:
        for part in text_slices(batch, 0, SET_BYTES):
            sets = [x for x in text_sets(part, 0) if len(x)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(x) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())],
                ["key", "set"])


def _with_key(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` and the class key of every row (null without a shingle)."""
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, at, SET_BYTES):
                keys = [_digest(x) if len(x) else None for x in text_sets(part, at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.binary())], [*part.schema.names, name])

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField(name, BinaryType())]))


def keep_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` less all but one of each near-duplicate group, all
    columns as they were.  Rows are judged by their own class, not by their id: one
    row with the smallest id (null last) of the class that stands for the group
    stays.  Rows without words stay."""
    _, facts = _judged(docs, text, doc_id)
    key, own, stands, first = (fresh(docs, c) for c in ("_key", "_own", "_stands", "_first"))
    verdict = stored(facts.where("not stands or copies > 1").select(
        F.col("key").alias(own), F.col("stands").alias(stands), F.col("class_id").alias(first)))
    copied = verdict.where(F.col(stands))
    named = copied.select(first).distinct()
    if at_most(verdict, BROADCAST_ROW_LIMIT):
        verdict, copied, named = F.broadcast(verdict), F.broadcast(copied), F.broadcast(named)  # else both sides are shuffled
    columns = [F.col(f"`{c}`") for c in docs.columns]
    same_id = F.col(f"`{doc_id}`").eqNullSafe(F.col(first))
    single = _with_key(docs, text, key).join(verdict, F.col(key) == F.col(own), "left_anti").select(*columns)
    # only rows with the smallest id of a copied class are read for the second part
    again = (_with_key(docs.join(named, same_id, "left_semi"), text, key)
             .join(copied, (F.col(key) == F.col(own)) & same_id, "left_semi").dropDuplicates([key]).select(*columns))
    return single.unionByName(again)


def op3_ngram_jaccard_join(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
