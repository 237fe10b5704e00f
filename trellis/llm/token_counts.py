"""Token counts of a unigram tokenizer without building tokens.

An Aho-Corasick automaton over the vocabulary lists every match by its end;
dynamic programming over the ends carries the best score and the number of
pieces on its path.  Ties follow the tokenizers library's unigram model:
of equal scores the piece that starts first (the longest) wins; a character
that is no piece costs the least score less ten and counts as its bytes
(byte fallback) or, with its neighbours, as one unknown token.  The piece that stands
for the unknown joins such a run where its own letters stand in the text: alone it is
one token, beside another unknown its letters count as bytes too.

The scores are taken from the vocabulary file as a unigram model's, whatever model the
file was made for.  ``piece_bpe_32k.model`` holds merge ranks as scores, so the counts
of its query are those of the unigram model with these scores, not those of the file's
own tokenizer.

No piece holds a blank mark after another character, so a text's best path is
the best paths of its blank-led words in order; each distinct word is solved
once per worker, and without the unknowns' bookkeeping where each of its characters is a
piece.  Scores of this vocabulary are whole numbers, so sums are
exact and ties are the same word by word as over the whole text.

Defined results: a null or empty text has 0 tokens and score 0; ids may be null
or repeated (row by row); an empty table gives an empty result; further columns
are ignored.  A word of any length is solved in memory of the longest piece.
"""

from __future__ import annotations

import math
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import Memo, documents, map_arrow, text_slices, texts_of, trim_together

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
#: Longest word that is solved in lists of its own length.
PLAIN_CHARS = 4096
#: Words whose results are held besides the memos.
LEARN_WORDS = 10_000


def vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """(piece, score) by id and the unknown id of a sentencepiece file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())], sp.unk_id()


class Counter:
    """Best score and piece count of texts under a unigram vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]], unknown_id: int | None = 0):
        import ahocorasick
        names = {p for p, _ in pieces}
        self.mark = pieces[unknown_id][0] if unknown_id is not None else ""
        self.byte_fallback = all(f"<0x{b:02X}>" in names for b in range(256))
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            if p:
                self.automaton.add_word(p, (len(p), s, p == self.mark))
        self.automaton.make_automaton()
        self.longest = max(len(p) for p, _ in pieces)
        inner = any(BLANK in p.lstrip(BLANK) for p in names)
        self.by_word = self.byte_fallback and not inner and not any("\n" in p for p in names)
        #: characters that are pieces: where all are, no unknown can be better
        self.singles = {p for p in names if len(p) == 1} if all(math.isfinite(s) for _, s in pieces) else set()
        self.counts, self.scores = Memo(), Memo()       # by word

    def solve(self, s: str) -> tuple[int, float]:
        """(pieces, score) of a normalised string.  A state holds the tokens before the run of
        unknowns that it ends with, and the run's tokens and parts (none: no run)."""
        size = self.longest + 1
        best, count, run, parts = [0.0] * size, [0] * size, [0] * size, [0] * size
        matches = self.automaton.iter(s)
        nxt = next(matches, None)
        for end in range(1, len(s) + 1):
            top = None
            from_, length, marked, single = 0, 0, False, False
            while nxt is not None and nxt[0] == end - 1:   # longest first
                n, score, is_mark = nxt[1]
                value = best[(end - n) % size] + score
                if top is None or value > top:
                    top, from_, length, marked = value, (end - n) % size, n, is_mark
                single |= n == 1
                nxt = next(matches, None)
            unknown = marked
            if not single:
                at = (end - 1) % size
                value = best[at] + self.unknown
                if top is None or value > top:
                    top, from_, length, marked, unknown = value, at, 1, False, True
            here = end % size
            if not unknown:
                count[here], run[here], parts[here] = count[from_] + run[from_] + 1, 0, 0
            else:
                # the run's tokens: its bytes, but one where it is the mark alone, or without byte fallback
                more = len(s[end - length:end].encode())
                held = run[from_] if parts[from_] != -1 else len(self.mark.encode())
                count[here] = count[from_]
                if not self.byte_fallback:
                    run[here], parts[here] = 1, 1
                elif parts[from_] == 0 and marked:
                    run[here], parts[here] = 1, -1          # the mark alone
                else:
                    run[here], parts[here] = held + more, 1
            best[here] = top
        here = len(s) % size
        return count[here] + run[here], best[here]

    def _plain(self, s: str, before: int, start: float) -> tuple[int, float]:
        """``solve`` of a string without unknowns, after ``before`` tokens of score ``start``: every
        character is a piece, so the best path to an end is one of the matches that end there."""
        # by last character; what stands before the first is kept last, where -1 finds it
        best, counts = [-math.inf] * len(s) + [start], [0] * len(s) + [before]
        for end, (n, score, _) in self.automaton.iter(s):   # of an end, longest first
            value = best[end - n] + score
            if value > best[end]:
                best[end] = value
                counts[end] = counts[end - n] + 1
        return counts[len(s) - 1], best[len(s) - 1]

    def solve_word(self, w: str) -> tuple[int, float]:
        """``solve`` of a word: a blank leads it unless a line break does, which is in no
        piece and counts as its byte."""
        broken = w[:1] == "\n"
        s = w[1:] if broken else BLANK + w
        if len(s) > PLAIN_CHARS or not self.singles.issuperset(s) or self.mark and self.mark in s:
            return self.solve(w if broken else s)
        return self._plain(s, 1, self.unknown) if broken else self._plain(s, 0, 0.0)

    def _learn(self, words) -> None:
        new = [w for w in set(words) if w not in self.counts]
        for i in range(0, len(new), LEARN_WORDS):
            some = new[i:i + LEARN_WORDS]
            found = list(map(self.solve_word, some))
            self.counts.put_all(dict(zip(some, (n for n, _ in found))))
            self.scores.put_all(dict(zip(some, (score for _, score in found))))

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if not self.by_word or self.mark and self.mark in text:     # a run may reach over words
            return self.solve(BLANK + text.replace(" ", BLANK))
        trim_together(self.counts, self.scores)     # a word is in both or in none
        words = text.replace("\n", " \n").split(" ")
        if "" in words or BLANK in text:
            words = self._joined(text)
        self._learn(words)
        return sum(map(self.counts.__getitem__, words)), sum(map(self.scores.__getitem__, words))

    @staticmethod
    def _joined(text: str) -> list[str]:
        """Words of a text with runs of blanks: a run belongs to what follows,
        but for its first blank, which every word has; before a line break or
        the end a run stands alone."""
        s = BLANK + text.replace(" ", BLANK)
        out, i, n = [], 0, len(s)
        while i < n:
            if s[i] == "\n":
                j = i + 1
            else:
                j = i
                while j < n and s[j] == BLANK:
                    j += 1
                if j < n and s[j] == "\n":
                    out.append(s[i + 1:j])
                    i = j
                    continue
            ends = [k for k in (s.find(BLANK, j), s.find("\n", j)) if k >= 0]
            k = min(ends, default=n)
            out.append(s[i:k] if s[i] == "\n" else s[i + 1:k])
            i = k
        return out


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(*vocabulary(path))


def token_counts(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens long, score double (of the best path): one row per document."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches):
        counter = _counter(path)
        for batch in batches:
            for part in text_slices(batch, 1):
                found = [counter.count(t) for t in texts_of(part, 1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([n for n, _ in found], pa.int64()),
                     pa.array([float(s) for _, s in found], pa.float64())], ["doc_id", "n_tokens", "score"])

    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, n_tokens long, score double")


def op10_token_counts(spark, sf_dir):
    import public_tokenizers
    return token_counts(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
