"""Byte-level BPE encoding and decoding with the tokenizers library.

The library works on characters, the vocabulary on bytes: each byte stands for
one printable character (``byte_alphabet``), and an id's characters turn back
into bytes by the reversed table.  The merges are rebuilt from the ranks: a
token may form from any two tokens that spell it, at the token's rank.

A text is encoded in chunks that end where a match of the split pattern must
end (before a lone space that a non-space follows), so its ids are the chunks'
ids in order, and each distinct chunk is encoded once per worker.

Offsets are in characters of the text: a token covers the characters that hold
its bytes; a character split between tokens belongs to all of them.  Decoding a
stream emits a split character when its last byte has come (``decode_stream``).

Defined results: a null text counts as empty and has no ids; a lone surrogate
cannot occur in Spark strings; ids may be null or repeated (row by row); an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import Memo, byte_ranks, documents, map_arrow, text_slices, texts_of

#: A space that white space or the text's end follows: the quick cut fails there.
_ODD = re.compile(r" (?=\s|$)")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself where it is printable
    Latin-1, else the next unused one from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(rest)) for b in range(256)]


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All pairs of tokens that spell a token, by the token's rank."""
    out = []
    for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
        for k in range(1, len(token)):
            if token[:k] in ranks and token[k:] in ranks:
                out.append((token[:k], token[k:]))
    return out


@lru_cache(maxsize=2)
def build(path: str, pattern: str):
    """A tokenizers pipeline with the ranks of the file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    ranks = byte_ranks(path)
    to = byte_alphabet()

    def chars(token: bytes) -> str:
        return "".join(to[b] for b in token)

    model = models.BPE(vocab={chars(t): i for t, i in ranks.items()},
                       merges=[(chars(a), chars(b)) for a, b in merges_of(ranks)], ignore_merges=True)
    own = Tokenizer(model)
    own.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return own


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id; b'' for an unused one."""
    ranks = byte_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        out[i] = token
    return out


def cut(text: str) -> list[str]:
    """Chunks of a text, each encoded by itself.  The common case is a split at
    every space; the space belongs to what follows."""
    if _ODD.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]


class ByteEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        self.tokenizer = build(path, pattern)
        self.known = Memo()                 # str -> bytes

    def learn(self, chunks) -> None:
        known = self.known
        fresh = list({c for c in chunks if c not in known})
        for i in range(0, len(fresh), 20_000):
            some = fresh[i:i + 20_000]
            for c, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                known.put(c, np.array(e.ids, "<u4").tobytes())

    def encode(self, texts: list[str]) -> list[bytes]:
        self.known.trim()
        chunks = [cut(t) for t in texts]
        self.learn(c for own in chunks for c in own)
        known = self.known
        return [b"".join([known[c] for c in own]) for own in chunks]


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> ByteEncoder:
    return ByteEncoder(path, pattern)


def char_offsets(data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token, from the text's UTF-8 bytes and
    the tokens' byte lengths."""
    if len(lengths) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    char = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
    end = np.cumsum(lengths)
    return char[end - lengths], char[end - 1] + 1


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, ids array<int>, starts and ends array<int> (characters)."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches):
        encoder = _encoder(path, pattern)
        size = np.array([len(b) for b in token_bytes(path)], np.int64)
        for batch in batches:
            for part in text_slices(batch, 1):
                texts = texts_of(part, 1)
                ids = [np.frombuffer(x, "<u4") for x in encoder.encode(texts)]
                at = [char_offsets(t.encode(), size[x]) for t, x in zip(texts, ids, strict=True)]
                lists = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.astype(np.int32) for x in ids], lists),
                     pa.array([a.astype(np.int32) for a, _ in at], lists),
                     pa.array([b.astype(np.int32) for _, b in at], lists)], ["doc_id", "ids", "starts", "ends"])

    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>")


def decode_ids(table: list[bytes], ids) -> bytes:
    return b"".join([table[i] for i in ids])


def decode_stream(table: list[bytes], ids):
    """Text of each id in turn; a split character comes with its last byte, and
    what never becomes a character comes as U+FFFD at the end."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for i in ids:
        yield decoder.decode(table[i])
    rest = decoder.decode(b"", final=True)
    if rest:
        yield rest


def decode(encoded: DataFrame, path: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and the decoded bytes of every row of ids (null ids: empty)."""
    kind = dict(encoded.dtypes)[doc_id]

    def run(batches):
        table = token_bytes(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([decode_ids(table, x or ()) for x in part.column(1).to_pylist()], pa.binary())],
                    ["doc_id", "bytes"])

    return map_arrow(encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")), run, f"doc_id {kind}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Digests of encoding and decoding: doc_id, n_tokens, ids_sha256,
    decoded_sha256, n_split_chars (characters shared by several tokens)."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches):
        encoder = _encoder(path, pattern)
        table = token_bytes(path)
        size = np.array([len(b) for b in table], np.int64)
        for batch in batches:
            for part in text_slices(batch, 1):
                n, ids_sha, out_sha, split = [], [], [], []
                for data in encoder.encode(texts_of(part, 1)):
                    ids = np.frombuffer(data, "<u4")
                    back = decode_ids(table, ids.tolist())
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(data).hexdigest())
                    out_sha.append(hashlib.sha256(back).hexdigest())
                    inner = np.cumsum(size[ids])[:-1]
                    follows = (np.frombuffer(back, np.uint8) & 0xC0) == 0x80
                    if follows.any():
                        first, end = char_offsets(back, size[ids])
                        split.append(len(np.unique(first[1:][follows[inner]])))
                    else:
                        split.append(0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                     pa.array(out_sha, pa.string()), pa.array(split, pa.int64())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split_chars"])

    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split_chars long")


def op7_byte_bpe(spark, sf_dir):
    import public_tokenizers as P
    return round_trip(documents(spark, sf_dir, "doc_id", "text"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
