"""Best-two-fit packing of tokenised documents into fixed-length sequences.

1. Every document is tokenised; one that is longer than a sequence is cut into
   full pieces and a rest.  Pieces carry their task and their running number
   among that task's pieces of the same length.
2. Only the number of pieces of each length (at most ``capacity`` numbers) is
   planned with.  A bin is filled greedily with the longest pieces that fit;
   then its smallest piece is replaced by the two unpacked pieces that fit the
   widened gap most tightly, if they fill it better.  A bin's recipe is used as
   often as the pieces last, so a plan has a few thousand recipes at any size.
3. The plan hands each piece its place by length and running number: summed
   counts give every task's offset among the pieces of a length, so no length,
   however common, gathers in one task.

Defined results: a null text counts as empty; an empty text is the one end
token; ids may be null or repeated (every row is packed); an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trellis.llm.byte_bpe import byte_alphabet
from trellis.llm.common import MEMO_BYTES, Memo, documents, map_arrow, text_slices, texts_of
from trellis.plans.tables import stored

CAPACITY = 4096
END_ID = 1


@lru_cache(maxsize=2)
def word_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


#: A word in lower-case Latin-1 letters and the punctuation after it: the tokenizer
#: splits between the two, and its normaliser leaves both as they are.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([^\w\s]*)")


def _lowered(text: str) -> str:
    """Lower case ahead of the tokenizer, for texts of Latin-1 characters only,
    where both lower character by character alike.  A text with ``<|`` keeps its
    case: the tokenizer looks for its special tokens before it lowers."""
    if "<|" in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


@lru_cache(maxsize=256)
def _packer(n: int):
    return struct.Struct(f"<{n}I").pack


class ChunkEncoder:
    """Token ids of whole texts, chunk by chunk.

    No token of this vocabulary reaches over white space and no rule of its
    normaliser or splitter looks past it, so a text's ids are those of its
    blank-separated chunks in order; each distinct chunk is tokenised once.  A
    plain word goes straight to the library's BPE model in the characters that
    stand for its bytes; anything else through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = word_tokenizer(path)
        self.model = self.tokenizer.model
        self.byte_chars = dict(enumerate(byte_alphabet()))
        self.known = Memo(2 * MEMO_BYTES)   # chunk -> bytes; a plain word is a chunk too
        self.marks = Memo()                 # punctuation by itself -> bytes, for the words it follows
        self.marks.put("", b"")

    def _word(self, word: str) -> bytes:
        # ASCII letters stand for their own bytes
        as_chars = word if word.isascii() else word.encode().decode("latin-1").translate(self.byte_chars)
        ids = [t.id for t in self.model.tokenize(as_chars)]
        return _packer(len(ids))(*ids)

    def _whole(self, chunks: list[str]) -> None:
        for i in range(0, len(chunks), 20_000):
            some = chunks[i:i + 20_000]
            for c, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4").tobytes()
                self.known.put(c, ids)
                if c and not any(x.isalnum() or x.isspace() for x in c) and c.isascii():
                    self.marks.put(c, ids)

    def _learn(self, chunks: set[str]) -> None:
        known, marks = self.known, self.marks
        new, later, rest = {}, [], []

        def learn_plain(c, word, tail):
            ids = new.get(word) or known.get(word)
            if ids is None:
                new[word] = ids = self._word(word)
            if c != word:
                new[c] = ids + tail

        for c in chunks:
            m = _PLAIN.fullmatch(c.lower())
            if m is None:
                rest.append(c)
                continue
            word, mark = m.groups()
            tail = marks.get(mark)
            if tail is None:
                later.append((c, word, mark))
            else:
                learn_plain(c, word, tail)
        self._whole(list({mark for _, _, mark in later if mark.isascii()}))
        for c, word, mark in later:
            if mark in marks:
                learn_plain(c, word, marks[mark])
            else:
                rest.append(c)
        known.put_all(new)
        self._whole(rest)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        self.known.trim()
        self.marks.trim()
        self.marks.put("", b"")
        chunks = [_lowered(t).replace("\n", " ").split(" ") for t in texts]
        known = self.known
        fresh = {c for own in chunks for c in own if c not in known}
        if fresh:
            self._learn(fresh)
        return [b"".join([known[c] for c in own]) for own in chunks]


@lru_cache(maxsize=2)
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


PIECE_SCHEMA = ("piece int, start long, length long, ids_crc32 long, task int, nth long")


def tokenise(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id",
             capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, task
    and nth (running number among the task's pieces of that length), and with
    ``ids`` the ids themselves."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = _encoder(vocabulary)
        task = TaskContext.get().partitionId()
        counts = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in text_slices(batch, 1):
                row, piece, start, length, crc, nth, own = [], [], [], [], [], [], []
                for r, data in enumerate(encoder.encode(texts_of(part, 1))):
                    data += end
                    for p, a in enumerate(range(0, len(data), 4 * capacity)):
                        cut = data[a:a + 4 * capacity]
                        n = len(cut) // 4
                        row.append(r)
                        piece.append(p)
                        start.append(a // 4)
                        length.append(n)
                        crc.append(zlib.crc32(cut))
                        nth.append(int(counts[n]))
                        counts[n] += 1
                        if ids:
                            own.append(np.frombuffer(cut, "<u4").astype(np.int32))
                cols = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                        pa.array([task] * len(row), pa.int32()), pa.array(nth, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
                if ids:
                    cols.append(pa.array(own, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    kind = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {kind}, {PIECE_SCHEMA}" + (", ids array<int>" if ids else "")
    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, schema)


def _longest(left: np.ndarray) -> np.ndarray:
    """For every room, the longest available length that fits (0: none)."""
    return np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))


def fill_bin(left: np.ndarray, capacity: int) -> dict[int, int]:
    """One bin's recipe (length -> copies) from the available counts ``left``."""
    bin_: dict[int, int] = {}
    room = capacity
    avail = left.copy()
    fits = _longest(avail)
    while room > 0 and (length := int(fits[room])):
        n = min(int(avail[length]), room // length)
        bin_[length] = n
        room -= n * length
        avail[length] -= n
        if avail[length] == 0:
            fits = _longest(avail)
    if room and sum(bin_.values()) > 1:
        small = min(bin_)
        gap = room + small
        # two pieces a >= b with small < a + b <= gap, the sum as large as can be
        fits = _longest(avail)
        a = np.flatnonzero(avail[:gap] > 0)
        b = fits[np.minimum(gap - a, a)]
        twice = (b == a) & (avail[a] < 2)
        b = np.where(twice, fits[np.maximum(a - 1, 0)], b)
        total = np.where(b > 0, a + b, 0)
        if len(total) and total.max() > small:
            k = int(total.argmax())
            bin_[small] -= 1
            for x in (int(a[k]), int(b[k])):
                bin_[x] = bin_.get(x, 0) + 1
    return {x: n for x, n in bin_.items() if n}


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Runs (length, first number, first sequence, copies, offset) that place
    the pieces ``first number`` on, ``copies`` to a sequence; number of sequences."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    while left.any():
        recipe = fill_bin(left, capacity)
        times = min(int(left[x]) // n for x, n in recipe.items())
        offset = 0
        for x in sorted(recipe, reverse=True):
            runs.append((x, int(used[x]), sequences, recipe[x], offset))
            offset += x * recipe[x]
            used[x] += times * recipe[x]
            left[x] -= times * recipe[x]
        sequences += times
    return np.array(sorted(runs), np.int64).reshape(-1, 5), sequences


def _place(runs: np.ndarray):
    """Arrow function that adds sequence_id and offset to numbered pieces."""
    def run(batches):
        key = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            r = runs[np.searchsorted(key, (length << 44) + number, side="right") - 1]
            step = number - r[:, 1]
            cols = {c: batch.column(c) for c in batch.schema.names if c != "number"}
            cols["sequence_id"] = pa.array(r[:, 2] + step // r[:, 3], pa.int64())
            cols["offset"] = pa.array(r[:, 4] + step % r[:, 3] * length, pa.int64())
            yield pa.RecordBatch.from_pydict(cols)
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows of ``tokenise``; ``task`` and ``nth`` go.

    ``pieces`` must be stored (checkpointed or written): numbers have to stay
    the same between the count and the placing.
    """
    spark = pieces.sparkSession
    # one row for each length and task, then for each length: at most `capacity`
    tally = stored(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(counts, capacity)
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = tally.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = (pieces.join(offsets, ["length", "task"])
                .withColumn("number", F.col("first") + F.col("nth")).drop("first", "task", "nth"))
    shared = spark.sparkContext.broadcast(runs)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number")
    return numbered.mapInArrow(lambda b: _place(shared.value)(b), f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    out = pack(stored(tokenise(docs, vocabulary)))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op4_best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir, "doc_id", "text"), vocabulary_path())
