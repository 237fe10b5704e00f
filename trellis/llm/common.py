"""Helpers shared by the corpus operators: Arrow slices, fresh names, word hashes."""

from __future__ import annotations

import base64
import ctypes
import math
import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.sources.tables import read_table

#: Word separators of every word-based operator: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
#: Python works through a batch in slices of about this many text bytes.
SLICE_BYTES = 4 << 20
#: Bytes of remembered results that a worker keeps in one ``Memo``.
MEMO_BYTES = 32 << 20


def documents(spark, sf_dir, *columns):
    return read_table(spark, sf_dir, "documents", *columns)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_slices(batch: pa.RecordBatch, index: int, limit: int = SLICE_BYTES):
    """Yield ``batch`` in consecutive slices of about ``limit`` bytes in the
    text column at ``index`` (one row at least), so that Python holds the
    strings of one slice at a time."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.binary_length(batch.column(index)).fill_null(0).to_numpy(zero_copy_only=False)
    slot = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = np.flatnonzero(np.diff(slot)) + 1
    start = 0
    for end in [*cuts.tolist(), n]:
        if end > start:
            yield batch.slice(start, end - start)
        start = end


class Memo(dict):
    """Remembered results of a worker, bounded in bytes: ``trim``, called between
    slices, empties it once what ``put`` stored takes over ``limit`` bytes."""

    def __init__(self, limit: int = MEMO_BYTES):
        super().__init__()
        self.limit, self.used = limit, 0

    def put(self, key, value) -> None:
        if key not in self:
            self.used += sys.getsizeof(key) + sys.getsizeof(value) + 100    # and its place in the table
        self[key] = value

    def put_all(self, new: dict) -> None:
        """``put`` for results whose keys are not held yet."""
        self.used += sum(map(sys.getsizeof, new)) + sum(map(sys.getsizeof, new.values())) + 100 * len(new)
        self.update(new)

    def trim(self) -> None:
        if self.used > self.limit:
            self.clear()
            self.used = 0


def trim_together(*memos: Memo) -> None:
    """``trim`` for memos with the same keys: all are emptied once one is over its limit."""
    if any(m.used > m.limit for m in memos):
        for m in memos:
            m.clear()
            m.used = 0


@lru_cache(maxsize=1)
def _malloc_trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):       # not the GNU C library
        return lambda _: 0


def release_memory() -> None:
    """Hand what Arrow's pool and the C library keep unused back to the system."""
    pa.default_memory_pool().release_unused()
    _malloc_trim()(0)


def releasing(run):
    """An Arrow function for ``mapInArrow`` that gives up unused memory at its
    task's end: Spark keeps the worker, which would otherwise idle with it."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()
    return wrapped


def gathered(batches, index: int, limit: int):
    """Consecutive batches joined up to about ``limit`` bytes of the text column at ``index``."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(index).nbytes
        if size >= limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULT = 64 << 20
#: Bytes of an Arrow batch between Spark and its Python workers, about.
BATCH_BYTES = 4 << 20


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` for rows with texts or vectors.  Batches are bounded in bytes,
    not only in rows: 10,000 texts would take tens of MB in the executor and as much in
    each worker.  A session whose own bound is not Spark's default keeps it.  Unused
    memory is given up at each task's end."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_CONF).rstrip("b") == str(_BATCH_DEFAULT):
        conf.set(_BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(releasing(run), schema)


def texts_of(batch: pa.RecordBatch, index: int) -> list[str]:
    """The text column as strings; a null counts as the empty text."""
    return [t or "" for t in batch.column(index).to_pylist()]


@lru_cache(maxsize=4)
def byte_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 token, blank, rank a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def shuffle_parts(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ------------------------------------------------------------------ word hashes

_U = np.uint64
_GOLD, _MIX1, _MIX2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit words."""
    with np.errstate(over="ignore"):
        x = x + _GOLD
        x = (x ^ (x >> _U(30))) * _MIX1
        x = (x ^ (x >> _U(27))) * _MIX2
        return x ^ (x >> _U(31))


_BYTE = mix64(np.arange(256, dtype=np.uint64))
_BASE = 0xD6E8FEB86659FD93
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


#: Bytes of text whose words are hashed at a time, and of a word that have powers of their own.
HASH_WINDOW = 2 << 20
_PLACE_BITS = 16


@lru_cache(maxsize=2)
def _powers(bits: int) -> np.ndarray:
    out = np.full(1 << bits, _U(_BASE))
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _terms(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """What each byte adds to its word's hash, by its place in the word."""
    with np.errstate(over="ignore"):
        out = _BYTE[data] * _powers(_PLACE_BITS)[place & ((1 << _PLACE_BITS) - 1)]
        far = place >> _PLACE_BITS
        if len(far) and far.max() > 0:
            out *= np.where(far > 0, mix64(far.astype(np.uint64)) | _U(1), _U(1))
        return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of consecutive texts.

    ``data`` holds the UTF-8 bytes of all texts, ``offsets`` (n + 1 long) their
    borders.  Returns the hashes in order and the n + 1 borders among them.  Bytes are
    read a window at a time; a word that a window leaves open goes on in the next.
    """
    sums, sizes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    last = 0
    for a in range(0, len(data), HASH_WINDOW):
        part = data[a:a + HASH_WINDOW]
        space = IS_SPACE[part]
        first = ~space
        first[1:] &= space[:-1]
        if a:
            first[0] &= IS_SPACE[data[a - 1]]
        border = offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, a + len(part))] - a
        first[border] = ~space[border]
        inside = np.flatnonzero(~space)
        if not len(inside):
            continue
        begin = np.flatnonzero(first) + a
        goes_on = not space[0] and not first[0]
        if goes_on:
            begin = np.concatenate([[last], begin])
        owner = np.cumsum(first)[inside] - (0 if goes_on else 1)
        terms = _terms(part[inside], inside + a - begin[owner])
        cut = np.flatnonzero(np.diff(owner, prepend=-1))
        with np.errstate(over="ignore"):
            own, n = np.add.reduceat(terms, cut), np.diff(np.append(cut, len(inside)))
            if goes_on:
                at = max(i for i, x in enumerate(sums) if len(x))
                sums[at][-1] += own[0]
                sizes[at][-1] += n[0]
                own, n, begin = own[1:], n[1:], begin[1:]
        sums.append(own)
        sizes.append(n)
        starts.append(begin)
        if len(begin):
            last = int(begin[-1])
    with np.errstate(over="ignore"):
        hashes = mix64(np.concatenate(sums) + np.concatenate(sizes).astype(np.uint64))
    if not len(hashes):
        return hashes[:0], np.zeros(len(offsets), np.int64)
    return hashes, np.searchsorted(np.concatenate(starts), offsets).astype(np.int64)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and row borders (a null is empty)."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each text, in order, and borders.
    A text of 1 to ``width - 1`` words has one shingle, all its words."""
    words, at = word_hashes(data, offsets)
    counts = np.diff(at)
    with np.errstate(over="ignore"):
        n = len(words) - width + 1
        full = np.zeros(max(n, 0), np.uint64)
        for k in range(width):
            if n > 0:
                full = full * _U(_BASE) + words[k:k + n]
        full = mix64(full)
        made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
        out_at = np.concatenate([[0], np.cumsum(made)])
        out = np.zeros(out_at[-1], np.uint64)
        long_ones = np.flatnonzero(counts >= width)
        if len(long_ones):
            per = made[long_ones]
            step = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
            out[np.repeat(out_at[long_ones], per) + step] = full[np.repeat(at[long_ones], per) + step]
        for r in np.flatnonzero((counts > 0) & (counts < width)):
            h = _U(int(counts[r]))
            for w in words[at[r]:at[r + 1]]:
                h = h * _U(_BASE) + w
            out[out_at[r]] = mix64(np.array([h], np.uint64))[0]
    return out, out_at


# ------------------------------------------------------------------ words as strings

#: Lower case of A to Z, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: A text longer than this is read in windows of about so many bytes.
WINDOW_BYTES = 4 << 20


def word_array(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of consecutive texts, as large strings, and the byte where each
    begins; ``gap`` tells for each byte of ``data`` whether it parts words."""
    first = ~gap
    first[1:] &= gap[:-1]
    border = offsets[:-1][offsets[:-1] < len(data)]
    first[border] = ~gap[border]
    start = np.flatnonzero(first)
    if not len(start):
        return pa.array([], pa.large_string()), start
    inside = ~gap
    held = np.cumsum(inside, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    ends = np.concatenate([[0], held[start[1:] - 1], held[-1:]]).astype(np.int64)
    # a word that the next text's first word follows without a gap ends at the border all the same
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])]), start


def window_ends(data: np.ndarray, is_gap: np.ndarray, size: int):
    """(start, end) of consecutive windows of about ``size`` bytes that end at a gap
    (``is_gap``: by byte value); a word longer than that stays whole."""
    n, a = len(data), 0
    while a < n:
        b = min(a + size, n)
        while b < n:
            step = np.flatnonzero(is_gap[data[b:b + 65536]])
            if len(step):
                b += int(step[0])
                break
            b = min(b + 65536, n)
        yield a, b
        a = b


def bits_for(n: float) -> int:
    return max(1, math.ceil(math.log2(max(2.0, n))))


def crc_of_id(column="doc_id"):
    """crc32 of the id's decimal text, the fold rule of the learned operators."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
