import random
import zlib

import numpy as np
import pytest

from tests.llm.cases import docs_frame, edge_rows, prose
from trellis.llm import packing as P


def check_layout(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= capacity
    return len(bins)


def test_pieces_against_whole_text_tokenizer(spark):
    odd = [(30, "Tab\tand no-break ümläut É"), (31, "it's <|endoftext|> here"), (32, "a  b   c\n\n\nd "), (33, "x" * 300),
           (34, "é ́ Å İi ΣΑΣ"), (35, prose(3, 9000))]
    data = edge_rows() + odd
    path = P.vocabulary_path()
    out = P.pack(P.tokenise(docs_frame(spark, data), path).checkpoint()).collect()
    whole = P.word_tokenizer(path)
    want = []
    for i, t in data:
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for p, a in enumerate(range(0, len(ids), 4096)):
            cut = ids[a:a + 4096]
            want.append((i or -1, p, a, len(cut), zlib.crc32(cut.tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    check_layout(out, 4096)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 50, 200])
    counts = {r.randint(1, capacity): r.randint(1, 400) for _ in range(r.randint(1, 20))}
    runs, sequences = P.plan(counts, capacity)
    place = {}
    for length, first, seq, copies, offset in runs.tolist():
        last = min([x[1] for x in runs.tolist() if x[0] == length and x[1] > first], default=counts[length])
        for n in range(first, last):
            place.setdefault(seq + (n - first) // copies, []).append((offset + (n - first) % copies * length, length))
    assert sum(map(len, place.values())) == sum(counts.values())
    assert sorted(place) == list(range(sequences))
    for own in place.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= capacity


def test_replaces_the_smallest_by_two_that_fit_better():
    left = np.zeros(11, np.int64)
    left[[6, 3, 2]] = [1, 1, 2]          # greedy: 6 + 3 (gap 1); two 2s fill the gap of 4
    assert P.fill_bin(left, 10) == {6: 1, 2: 2}


def test_one_common_length_and_empty_table(spark):
    df = docs_frame(spark, [(i, "same words here") for i in range(500)])
    out = P.pack_documents(df, P.vocabulary_path()).collect()
    assert check_layout(out, 4096) == 1 and len(out) == 500
    assert P.pack_documents(docs_frame(spark, []), P.vocabulary_path()).count() == 0


def test_ids_are_returned_on_request(spark):
    row = P.tokenise(docs_frame(spark, [(1, "one two")]), P.vocabulary_path(), ids=True).first()
    assert row.ids[-1] == 1 and len(row.ids) == row.length


def test_a_word_is_tokenised_once_whatever_follows_it(monkeypatch):
    encoder = P.ChunkEncoder(P.vocabulary_path())
    tried = []
    word = encoder._word
    monkeypatch.setattr(encoder, "_word", lambda w: tried.append(w) or word(w))
    texts = ["straße, straße. Straße (straße)", "straße; STRASSE! straße", "straße…", "straße,"]
    whole = P.word_tokenizer(P.vocabulary_path())
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(tried) == ["strasse", "straße"]
    assert encoder.known["straße"] + encoder.marks[","] == encoder.known["straße,"]
    assert sum(map(len, encoder.known)) < 100 and "straße" not in encoder.marks       # kept in one place
