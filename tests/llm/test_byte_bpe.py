import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tests.llm.cases import docs_frame, edge_rows, prose
from trellis.llm import byte_bpe as B
from trellis.llm.common import byte_ranks

PATH = P.path("byte_bpe_50k.tiktoken")
TEXTS = ["a  b   c", "a\t \nb", " lead", "trail ", "x\n y", "it's we'll  I'm", "日本語 テキスト　x", "  a  b", "\x1c \x1d a",
         "1234567 89", "😀😀 é é", "<|endoftext|> a", "   ", "\n\n\n", "a \r\n b", "aaaaaaaaaaaaaaaaaaaaaaa" * 40, "абв где", " ́x"]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_ranks(PATH), special_tokens={})


def test_ids_are_those_of_the_rank_library(reference):
    texts = TEXTS + [a + b for a in TEXTS for b in TEXTS] + [t or "" for _, t in edge_rows()]
    got = B.ByteEncoder(PATH, P.PATTERN).encode(texts)
    for t, data in zip(texts, got, strict=True):
        assert np.frombuffer(data, "<u4").tolist() == reference.encode_ordinary(t), repr(t)


def test_round_trip_and_edges(spark, reference):
    data = edge_rows() + [(100 + i, t) for i, t in enumerate(TEXTS)]
    df = docs_frame(spark, data)
    out = B.round_trip(df, PATH, P.PATTERN).collect()
    want = sorted((i or -1, hashlib.sha256(np.array(reference.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in data)
    assert sorted((r.doc_id or -1, r.ids_sha256, r.decoded_sha256) for r in out) == want
    assert B.round_trip(docs_frame(spark, []), PATH, P.PATTERN).count() == 0


def test_offsets_cover_the_text(spark, reference):
    text = "é 😀 日本 plain"
    row = B.encode(docs_frame(spark, [(1, text)]), PATH, P.PATTERN).first()
    for i, a, b in zip(row.ids, row.starts, row.ends, strict=True):
        assert reference.decode_single_token_bytes(i) in text[a:b].encode()
    assert row.starts[0] == 0 and row.ends[-1] == len(text)


def test_decoding_joins_split_characters(spark):
    table = B.token_bytes(PATH)
    text = "a😀b" + prose(1, 5)
    ids = np.frombuffer(B.ByteEncoder(PATH, P.PATTERN).encode([text])[0], "<u4").tolist()
    assert "".join(B.decode_stream(table, ids)) == text
    assert "".join(B.decode_stream(table, ids[:2])) == "a�"
    enc = B.encode(docs_frame(spark, [(1, text), (2, None)]), PATH, P.PATTERN)
    assert {r.doc_id: bytes(r.bytes) for r in B.decode(enc, PATH).collect()} == {1: text.encode(), 2: b""}


def test_byte_alphabet_is_reversible():
    to = B.byte_alphabet()
    assert len(set(to)) == 256 and to[ord("A")] == "A" and to[32] == chr(288)
