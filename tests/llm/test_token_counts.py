import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer, models, normalizers

from tests.llm.cases import docs_frame, edge_rows
from trellis.llm import token_counts as C

PATH = P.path("piece_bpe_32k.model")


def library(pieces, unknown, byte_fallback):
    t = Tokenizer(models.Unigram(pieces, unk_id=unknown, byte_fallback=byte_fallback))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


TEXTS = ["a  b", " lead", "trail  ", "\nx", "x \n y", "  \n\n ", "▁ mark▁mark", "<0x0A> <s>", "日本語テキスト 😀", "don't stop\tnow", "é" * 50,
         "a" * 400, "▁", " ", "\n", "<unk>", "Ö<unk>\n", "<unk><unk>", "a<unk>b", "<unk> \x01<unk>", "x <unk>\n<unk> \x02"]


def test_counts_are_those_of_the_library(spark):
    pieces, unknown = C.vocabulary(PATH)
    count = library(pieces, unknown, True)
    data = edge_rows() + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(200 + i, a + b) for i, (a, b) in enumerate(
        (a, b) for a in TEXTS for b in TEXTS)]
    out = C.token_counts(docs_frame(spark, data), PATH).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in out) == sorted((i or -1, count(t or "")) for i, t in data)
    by = {r.doc_id: (r.n_tokens, r.score) for r in out}
    assert by[2] == by[3] == (0, 0.0) and by[1] == by[6]
    assert C.token_counts(docs_frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_ties_of_small_vocabularies(seed):
    r = random.Random(seed)
    pieces = [("<unk>", 0.0)] + [(p, -float(r.randint(1, 4))) for p in sorted({
        "".join(r.choice("ab▁") for _ in range(r.randint(1, 4))) for _ in range(14)})]
    counter, count = C.Counter(pieces), library(pieces, 0, False)
    for _ in range(200):
        text = "".join(r.choice("abc ") for _ in range(r.randint(0, 14)))
        assert counter.count(text)[0] == count(text), (pieces, text)


def test_random_texts_with_the_unknown_mark():
    pieces, unknown = C.vocabulary(PATH)
    count, counter = library(pieces, unknown, True), C.Counter(pieces, unknown)
    r = random.Random(3)
    for _ in range(1500):
        text = "".join(r.choice(["<unk>", "a", " ", "\n", "\x01", "\ue000", "the", "<", "unk>", "▁"]) for _ in range(r.randint(1, 9)))
        assert counter.count(text)[0] == count(text), repr(text)


@pytest.mark.parametrize("seed", range(4))
def test_unknown_mark_without_byte_fallback(seed):
    r = random.Random(50 + seed)
    pieces = [("<unk>", 0.0), ("▁", -2.0), ("a", -1.0), ("<", -3.0), ("ab", -1.0)]
    counter, count = C.Counter(pieces), library(pieces, 0, False)
    for _ in range(200):
        text = "".join(r.choice(["<unk>", "a", "b", " ", "x", "<"]) for _ in range(r.randint(1, 8)))
        assert counter.count(text)[0] == count(text), repr(text)


def test_counts_and_scores_are_forgotten_together():
    """The counts take more bytes than the scores, so each reached its limit at another text."""
    pieces = [("<unk>", 0.0), ("▁a", -1.0), ("b", -2.0), *((f"<0x{x:02X}>", -9.0) for x in range(256))]
    counter, fresh = C.Counter(pieces), C.Counter(pieces)
    counter.counts.limit = counter.scores.limit = 30_000
    texts = [f"a{k} b{k * 7 % 300}" for k in range(1000)]
    for t in texts:
        assert counter.count(t) == fresh.count(t)
        assert counter.counts.keys() == counter.scores.keys()


def test_words_of_known_characters_need_no_unknowns(monkeypatch):
    """Nearly all words; keeping the runs of unknowns for them took twice the time."""
    pieces, unknown = C.vocabulary(PATH)
    counter, count = C.Counter(pieces, unknown), library(pieces, unknown, True)
    text = "the cat sat\non a mat\n\nby the é-door, 12 times"
    expected = C.Counter(pieces, unknown).solve(C.BLANK + text.replace(" ", C.BLANK))
    monkeypatch.setattr(counter, "solve", lambda s: pytest.fail(f"solved with unknowns: {s!r}"))
    assert counter.count(text) == expected and expected[0] == count(text)


@pytest.mark.parametrize("seed", range(6))
def test_words_solved_either_way_agree(seed):
    r = random.Random(80 + seed)
    some = {"".join(r.choice("abé") for _ in range(r.randint(2, 5))) for _ in range(20)}
    pieces = [("<unk>", 0.0), *((f"<0x{x:02X}>", -9.0) for x in range(256))]
    pieces += [(p, r.choice([-1.0, -2.0, -r.random() * 3])) for p in [*"▁abé", "▁a", "▁ab", *sorted(some)]]
    counter = C.Counter(pieces)
    assert counter.by_word
    for _ in range(400):
        w = r.choice(["", "", "\n"]) + "".join(r.choice("aabbéé" if r.random() < .9 else ["c", "<unk>", "▁", "😀"])
                                               for _ in range(r.randint(0, 12)))
        assert counter.solve_word(w) == counter.solve(w if w[:1] == "\n" else C.BLANK + w), repr(w)
    for w in ("ab" * C.PLAIN_CHARS, "\n" + "ab" * C.PLAIN_CHARS, "a" * (C.PLAIN_CHARS - 1), "a" * C.PLAIN_CHARS):
        assert counter.solve_word(w) == counter.solve(w if w[:1] == "\n" else C.BLANK + w)
