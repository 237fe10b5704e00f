"""Vector code compression: product codes, nearest entries by equal-average search.

Components become whole numbers, floor(256 x), and a vector is cut into ``PARTS`` equal
parts.  Each part position has a codebook of ``ENTRIES`` entries, which starts as that
part of the vectors with the smallest ids; ``ROUNDS`` times every part goes to its
nearest entry (squared distance, ties to the lower index) and every entry that is
used becomes the floored mean of its parts.

The nearest entry is found by the sums of the components.  Of two vectors of d
components whose sums differ by g, the squared distance is at least g * g / d
(Cauchy-Schwarz).  So a codebook's entries are sorted by sum; from its own place in
that order a part looks at the entries outwards, next on each side, and closes a side
once g * g > d * best: strictly, since an entry as near as the best may have the
lower index.  All arithmetic is in whole numbers.

Spark holds the vectors; a round sends back counts and component sums by (part, entry),
summed before the shuffle, so what reaches the driver is one codebook: PARTS x ENTRIES
rows.  Codebooks go to the tasks as a broadcast of that size.

Defined results: a row whose vector is null or holds a null or non-finite component is
dropped; ids may be repeated or null (each row is coded; rows with equal ids start
codebooks in the order of their vectors, null ids last); the row that is first in that
order fixes the length; a vector of another length, or a length that ``PARTS`` does not
divide, gives null code and error, and is no part of a codebook; fewer rows than
``ENTRIES`` start as many entries; components beyond 2**12 are worked out in Python's
whole numbers, and an error beyond 64 bits is null; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import map_arrow
from trellis.plans.sizing import BROADCAST_ROW_LIMIT, at_most
from trellis.plans.tables import stored
from trellis.sources.tables import read_table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors that a task works on at a time.
BLOCK = 2000
#: Whole numbers up to this, in parts of up to this many, are squared and summed in 64 bits.
_PLAIN, _PLAIN_WIDTH = 1 << 20, 1 << 10


@dataclass
class Codebook:
    """The entries of one part position, in their own order and by sum."""

    entries: np.ndarray                     # n x d, int64 or Python's whole numbers
    order: np.ndarray = field(init=False)   # entries by sum, equal sums by index
    sums: np.ndarray = field(init=False)    # in that order

    def __post_init__(self):
        total = self.entries.sum(axis=1)
        self.order = np.argsort(total, kind="stable")
        self.sums = total[self.order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index and squared distance of each part's nearest entry, and the number of
        distances computed.  All parts step outwards together; those that have
        closed both sides drop out."""
        n, d = len(self.entries), parts.shape[1]
        total = parts.sum(axis=1)
        best = np.full(len(parts), -1, total.dtype)
        found = np.zeros(len(parts), np.int64)
        place = np.searchsorted(self.sums, total)
        computed = 0
        for step in (1, -1):                # upwards from the part's sum, then downwards
            at = place - (step < 0)
            rows = np.flatnonzero((at >= 0) & (at < n))
            while len(rows):
                gap = total[rows] - self.sums[at[rows]]
                rows = rows[(best[rows] < 0) | (gap * gap <= d * best[rows])]
                entry = self.order[at[rows]]
                off = parts[rows] - self.entries[entry]
                far = (off * off).sum(axis=1)
                computed += len(rows)
                nearer = (best[rows] < 0) | (far < best[rows]) | ((far == best[rows]) & (entry < found[rows]))
                best[rows[nearer]], found[rows[nearer]] = far[nearer], entry[nearer]
                at[rows] += step
                rows = rows[(at[rows] >= 0) & (at[rows] < n)]
        return found, best, computed


def whole(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a column of ``width`` components, and their whole numbers."""
    lists = column.cast(pa.list_(pa.float64()))
    lengths = np.asarray(lists.value_lengths().fill_null(-1))
    rows = np.flatnonzero(lengths == width)
    flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * SCALE)
    if np.abs(scaled).max(initial=0) <= _PLAIN and width <= PARTS * _PLAIN_WIDTH:
        return rows, scaled.astype(np.int64)
    # exactly, also where the product leaves the range of a double
    exact = np.array([SCALE * int(x) if abs(x) > 1 << 53 else int(np.floor(x * SCALE)) for x in flat.ravel()], object)
    return rows, exact.reshape(len(rows), width)


def assign(books: list[Codebook], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry indexes (rows x parts) and total squared distance of each vector."""
    d = vectors.shape[1] // PARTS
    codes = np.zeros((len(vectors), PARTS), np.int64)
    error = np.zeros(len(vectors), vectors.dtype)
    for p, book in enumerate(books):
        codes[:, p], far, _ = book.nearest(vectors[:, p * d:(p + 1) * d])
        error = error + far
    return codes, error


def _parts_sum(books):
    """Arrow function: (part, entry, n, totals) of a task's parts by entry, the sums of
    their components as text."""
    def run(batches):
        d = books.value[0].entries.shape[1]
        counts = np.zeros((PARTS, ENTRIES), np.int64)
        sums = np.zeros((PARTS, ENTRIES, d), object)
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                _, vectors = whole(batch.column(0).slice(a, BLOCK), d * PARTS)
                codes, _ = assign(books.value, vectors)
                for p in range(PARTS):
                    used, own = np.unique(codes[:, p], return_inverse=True)
                    block = np.zeros((len(used), d), vectors.dtype)
                    np.add.at(block, own, vectors[:, p * d:(p + 1) * d])
                    sums[p, used] += block
                    counts[p, used] += np.bincount(own, minlength=len(used))
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
             pa.array([[str(x) for x in row] for row in sums[part, entry]], pa.list_(pa.string()))],
            ["part", "entry", "n", "totals"])
    return run


def _mean(key, table):
    n = sum(table.column("n").to_pylist())
    totals = np.array([[int(x) for x in row] for row in table.column("totals").to_pylist()], object).sum(axis=0)
    return pa.table([pa.array([k.as_py()], pa.int32()) for k in key] + [pa.array([[str(x // n) for x in totals]], pa.list_(pa.string()))],
                    names=["part", "entry", "means"])


def _numbers(values: np.ndarray) -> np.ndarray:
    """As 64-bit integers where those are safe."""
    plain = values.shape[1] <= _PLAIN_WIDTH and all(abs(x) <= _PLAIN for x in values.ravel())
    return values.astype(np.int64) if plain else values


def _update(vectors: DataFrame, books: list[Codebook]) -> list[Codebook]:
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    rows = (map_arrow(vectors.select("vec"), _parts_sum(shared), "part int, entry int, n long, totals array<string>")
            .groupBy("part", "entry").applyInArrow(_mean, "part int, entry int, means array<string>").toArrow())
    entries = [np.array(b.entries, object) for b in books]
    for part, entry, means in zip(*[rows[c].to_pylist() for c in ("part", "entry", "means")], strict=True):
        entries[part][entry] = [int(x) for x in means]
    return [Codebook(_numbers(x)) for x in entries]


def usable(vec: str):
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(F.col(vec), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def fit(vectors: DataFrame, rounds: int = ROUNDS) -> list[Codebook]:
    """Codebooks of (vec_id, vec) rows, all usable; none where no vector can be cut."""
    first = (vectors.select(F.col("vec_id").isNull().alias("none"), "vec_id", "vec").orderBy("none", "vec_id", "vec")
             .limit(ENTRIES).select("vec").toArrow()["vec"].combine_chunks())
    width = len(first[0].values) if len(first) else 0
    if not width or width % PARTS:
        return []
    _, start = whole(first, width)
    if len(start) < ENTRIES:            # some of the first have another length
        own = vectors.where(F.size("vec") == width)
        first = (own.select(F.col("vec_id").isNull().alias("none"), "vec_id", "vec").orderBy("none", "vec_id", "vec")
                 .limit(ENTRIES).select("vec").toArrow()["vec"].combine_chunks())
        _, start = whole(first, width)
    d = width // PARTS
    books = [Codebook(_numbers(np.array(start[:, p * d:(p + 1) * d], object))) for p in range(PARTS)]
    for _ in range(rounds):
        books = _update(vectors, books)
    return books


def digest(books: list[Codebook]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.entries.ravel()).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[Codebook]) -> DataFrame:
    """``vectors`` (any columns, and vec) with code and error."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    at = vectors.columns.index("vec")
    others = [i for i in range(len(vectors.columns)) if i != at]

    def run(batches):
        width = PARTS * shared.value[0].entries.shape[1] if shared.value else -1
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                code, error = [None] * part.num_rows, [None] * part.num_rows
                if width > 0:
                    rows, own = whole(part.column(at), width)
                    codes, far = assign(shared.value, own)
                    for r, c, e in zip(rows.tolist(), codes.astype(np.uint8), far.tolist(), strict=True):
                        code[r], error[r] = c.tobytes().hex(), e if e < 1 << 63 else None
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in others], pa.array(code, pa.string()), pa.array(error, pa.int64())],
                    [*[part.schema.names[i] for i in others], "code", "error"])

    fields = ", ".join(f"`{vectors.columns[i]}` {vectors.dtypes[i][1]}" for i in others)
    return map_arrow(vectors, run, f"{fields}, code string, error long")


def compress(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: one row per usable vector."""
    own = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vec}`").alias("vec"), F.col(f"`{label}`").alias("label"))
    own = own.where(usable("vec"))
    books = fit(own.select("vec_id", "vec"))
    coded = stored(encode(own, books))
    # sums are exact: 38 digits, then a long where they fit
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("total"))
    sums = sums.select(F.col("label").alias("own"), F.expr("try_cast(total as bigint)").alias("label_error"))
    if at_most(sums, BROADCAST_ROW_LIMIT):
        sums = F.broadcast(sums)            # else both sides are shuffled, and AQE splits a common label
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("own")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle_sql(width: int = 64) -> str:
    """DuckDB SQL for vectors of ``width`` components, every entry tried."""
    d = width // PARTS

    def assigned(book):
        return f"""SELECT vec_id, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM (
    SELECT v.vec_id, v.part, b.entry, sum((v.x - b.x) * (v.x - b.x))::BIGINT AS far
    FROM v JOIN {book} b ON b.part = v.part AND b.pos = v.pos GROUP BY v.vec_id, v.part, b.entry) GROUP BY vec_id, part"""

    steps = []
    for k in range(1, ROUNDS + 1):
        steps.append(f"""a{k} AS MATERIALIZED ({assigned(f"b{k - 1}")}),
m{k} AS (SELECT v.part, a.entry, v.pos, sum(v.x)::HUGEINT AS s, count(*) AS c FROM v JOIN a{k} a ON a.vec_id = v.vec_id AND a.part = v.part
  GROUP BY v.part, a.entry, v.pos),
b{k} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce(((m.s - (((m.s % m.c) + m.c) % m.c)) // m.c)::BIGINT, b.x) AS x
  FROM b{k - 1} b LEFT JOIN m{k} m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)""")
    return f"""
WITH e AS MATERIALIZED (SELECT vec_id, label, embedding AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, unnest(vec) AS x, unnest(range(len(vec))) AS i FROM e),
v AS MATERIALIZED (SELECT vec_id, (i // {d})::INT AS part, (i % {d})::INT AS pos, floor(x::DOUBLE * {SCALE})::BIGINT AS x FROM u),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e ORDER BY vec_id LIMIT {ENTRIES}),
b0 AS MATERIALIZED (SELECT v.part, f.entry, v.pos, v.x FROM v JOIN f ON f.vec_id = v.vec_id),
{", ".join(steps)},
z AS MATERIALIZED ({assigned(f"b{ROUNDS}")}),
c AS (SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM z GROUP BY vec_id),
h AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT e.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY e.label))::BIGINT AS label_error, h.codebooks_sha256
FROM e JOIN c ON c.vec_id = e.vec_id, h"""


def op11_equal_average(spark, sf_dir):
    return compress(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
