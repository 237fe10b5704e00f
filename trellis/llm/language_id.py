"""Language identification of mixed-language text.

Each word gets one score per language: script ranges first narrow the candidate
languages to those seen with the word's script in training, then a naive Bayes
model over the whole word and its character n-grams scores the candidates.  A
Viterbi pass over the words of a document, with a fixed penalty for switching
language, labels spans.  The document's language is the one whose spans hold
the most letters; its score is that share, weighed by the spans' confidence.

The model is a sparse table of hashed n-gram log-probabilities: for each of
``BUCKETS`` buckets the languages that have it.  Every learned language is in it;
its size follows the n-grams of the training rows, not the corpus.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
ids may be null or repeated (row by row); an empty table gives an empty result;
without any labelled row every text is ``und``; further columns are ignored.

``keep_documents`` tells "no letter" from "nothing learned": a text without a
letter goes; without a learned language every text with a letter stays; else a
text stays if it has a main language, one whose spans hold at least ``KEEP_SHARE`` of its
letters.  A text in one language has, with names, quotations and passages of others in it,
and so do words that give no evidence (they stay in their neighbours' span); a text
pieced together from two or more languages in like parts has not.
"""

from __future__ import annotations

import math
import sys
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import crc_of_id, documents, map_arrow, mix64, text_slices, texts_of

_U = np.uint64

BUCKETS = 1 << 15
#: The model is fitted on all labelled rows if they are at most so many, else
#: on about so many distinct texts, chosen by their hash ...
MAX_TRAINING_ROWS = 20_000
#: ... and on about so many of a language at least (all, if it has fewer).
FLOOR_ROWS = 50
SWITCH_PENALTY = 12.0
#: A word's log-score lies at most so far below its best language's.
WORD_RANGE = 6.0
#: Distinct training words that a task holds before it counts their n-grams.
CACHE_WORDS = 300_000
#: Bytes of remembered words and scores that a worker keeps.
CACHE_BYTES = 64 << 20
#: (n-gram, language) pairs and scores that a worker works on at a time.
WORK_PAIRS = 250_000
#: Words whose n-grams are counted at a time.
COUNT_WORDS = 10_000
#: Least share of a kept text's letters in the spans of one language.
KEEP_SHARE = 0.6

#: First code points of script ranges (Unicode blocks) and names.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"),
    (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"),
    (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB13, "other"), (0x20000, "han"), (0x32000, "other"),
]
_STARTS = [a for a, _ in SCRIPTS]


def script_of(letters: str) -> str:
    """The script of most of the letters, the first of equals."""
    if letters.isascii():
        return "latin"
    found: dict[str, int] = {}
    for ch in letters:
        s = SCRIPTS[bisect_right(_STARTS, ord(ch)) - 1][1]
        found[s] = found.get(s, 0) + 1
    return max(found, key=found.get)


def letters_of(word: str) -> str:
    """Its characters of a Unicode letter category (not numerals such as Roman ones)."""
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word (letters only), lower-cased, and of its 1- to 3-grams
    with borders; with each bucket the number of its word."""
    text = "".join([f"<{w.lower()}>" for w in words])
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens, closes = c == ord("<"), c == ord(">")
    word = np.cumsum(opens) - 1
    start = np.flatnonzero(opens)
    m = mix64(c)
    one = np.flatnonzero(~opens & ~closes)
    two = np.flatnonzero(~closes)
    three = two[:-1][~closes[two[:-1] + 1]] if len(two) > 1 else two[:0]
    place = (np.arange(len(c)) - start[word]).astype(np.uint64)
    with np.errstate(over="ignore"):
        whole = np.add.reduceat(mix64(m + place), start)
        hashes = np.concatenate([m[one] + _U(1), m[two] * _U(3) + m[two + 1] + _U(2),
                                 (m[three] * _U(3) + m[three + 1]) * _U(5) + m[three + 2] + _U(3), whole + _U(4)])
    own = np.concatenate([word[one], word[two], word[three], np.arange(len(start))])
    return (mix64(hashes) & _U(BUCKETS - 1)).astype(np.int64), own


@dataclass
class LanguageModel:
    languages: list[str]
    starts: np.ndarray                      # BUCKETS + 1 borders among the pairs of each bucket
    owners: np.ndarray                      # language of each (bucket, language) pair
    gains: np.ndarray                       # its log-probability above the language's unseen bucket
    unseen: np.ndarray                      # by language, log-probability of a bucket without a count
    scripts: dict[str, np.ndarray]          # script -> languages seen with it, ascending

    def _sums(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word by language, all languages."""
        k = len(self.languages)
        out = np.empty((len(words), k))
        step = max(1, WORK_PAIRS // (16 * k))
        for i in range(0, len(words), step):
            some = words[i:i + step]
            buckets, own = gram_buckets(some)
            grams = np.bincount(own, minlength=len(some))
            first = self.starts[buckets]
            n = self.starts[buckets + 1] - first
            at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            gained = np.bincount(np.repeat(own * k, n) + self.owners[at], self.gains[at], len(some) * k)
            out[i:i + step] = gained.reshape(-1, k) + grams[:, None] * self.unseen
        return out

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters of each word and its score by language: 0 for the best of its
        candidates, down to -WORD_RANGE; all 0 where a word gives no evidence."""
        letters = [letters_of(w) for w in words]
        scores = np.zeros((len(words), len(self.languages)), np.float32)
        by_script: dict[str, list[int]] = {}
        for i, x in enumerate(letters):
            if x:
                by_script.setdefault(script_of(x), []).append(i)
        step = max(1, WORK_PAIRS // len(self.languages))
        for script, rows in by_script.items():
            found = self.scripts.get(script)
            for i in range(0, len(rows) if found is not None else 0, step):
                some = rows[i:i + step]
                own = self._sums([letters[j] for j in some])[:, found]
                scores[some] = -WORD_RANGE
                scores[np.ix_(some, found)] = np.maximum(own - own.max(axis=1, keepdims=True), -WORD_RANGE)
        return np.array([len(x) for x in letters], np.int64), scores


class WordTable:
    """Scores of the distinct words seen by a worker, in one growing table."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.reset()

    def reset(self):
        self.at: dict[str, int] = {}
        self.used = 0
        self.letters = np.zeros(0, np.int64)
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)

    def rows(self, words: list[list[str]]) -> np.ndarray:
        """Table rows of all words in order."""
        if self.used > CACHE_BYTES:
            self.reset()
        at = self.at
        fresh = list({w for own in words for w in own if w not in at})
        if fresh:
            letters, scores = self.model.word_scores(fresh)
            at.update(zip(fresh, range(len(at), len(at) + len(fresh)), strict=True))
            self.used += sum(map(sys.getsizeof, fresh)) + 140 * len(fresh) + letters.nbytes + scores.nbytes
            self.letters = np.concatenate([self.letters, letters])
            self.scores = np.concatenate([self.scores, scores])
        return np.array([at[w] for own in words for w in own], np.int64)


def _count_batches(batches):
    """Counts of a partition, summed before anything is shuffled."""
    counts: dict[str, np.ndarray] = {}
    seen: dict[tuple[str, str], int] = {}
    words: dict[str, dict[str, int]] = {}

    def spend():
        for lang, own in words.items():
            at, weight = [], []
            for w, n in own.items():
                if letters := letters_of(w):
                    at.append(letters)
                    weight.append(n)
                    script = script_of(letters)
                    seen[lang, script] = seen.get((lang, script), 0) + n
            total = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for i in range(0, len(at), COUNT_WORDS):
                buckets, word = gram_buckets(at[i:i + COUNT_WORDS])
                total += np.bincount(buckets, np.array(weight[i:i + COUNT_WORDS], np.float64)[word], BUCKETS).astype(np.int64)
        words.clear()

    for batch in batches:
        for part in text_slices(batch, 0):
            for text, lang in zip(texts_of(part, 0), part.column(1).to_pylist(), strict=True):
                own = words.setdefault(lang, {})
                for w in text.split():
                    own[w] = own.get(w, 0) + 1
            if sum(map(len, words.values())) > CACHE_WORDS:
                spend()
    spend()
    rows = [(lang, None, int(b), int(c[b])) for lang, c in counts.items() for b in np.flatnonzero(c)]
    rows += [(lang, script, 0, n) for (lang, script), n in seen.items()]
    for i in range(0, len(rows), 20_000):
        cols = list(zip(*rows[i:i + 20_000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                          pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64())],
                                         ["lang", "script", "bucket", "n"])


def training_rows(rows: DataFrame, max_rows: int) -> tuple[list[str], DataFrame]:
    """The languages of (text, lang) rows and the rows to fit on: all of them, or
    each chosen text of a language once, so that copies count as one text."""
    rows = rows.withColumn("hash", F.xxhash64("text"))
    by_lang = rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_distinct("hash").alias("texts")).collect()
    languages = sorted(r["lang"] for r in by_lang)
    if sum(r["n"] for r in by_lang) > max_rows:
        whole = 1_000_000_000
        even = max_rows / sum(r["texts"] for r in by_lang)
        cuts = [(r["lang"], math.ceil(whole * min(1.0, max(even, FLOOR_ROWS / r["texts"])))) for r in by_lang]
        cuts = rows.sparkSession.createDataFrame(cuts, "lang string, cut long")
        rows = (rows.join(F.broadcast(cuts), "lang").where(F.pmod("hash", F.lit(whole)) < F.col("cut"))
                .dropDuplicates(["lang", "hash"]))
    return languages, rows.select("text", "lang")


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", max_rows: int = MAX_TRAINING_ROWS) -> LanguageModel:
    """Learn from rows with text and language.  What reaches the driver is the
    summed counts: one row for each n-gram bucket and script of a language."""
    languages, rows = training_rows(labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang")), max_rows)
    if not languages:
        return LanguageModel([], np.zeros(BUCKETS + 1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0), {})
    summed = (map_arrow(rows, _count_batches, "lang string, script string, bucket int, n long")
              .groupBy("lang", "script", "bucket").agg(F.sum("n").alias("n")).toArrow())
    place = pc.index_in(summed["lang"], pa.array(languages)).to_numpy()
    counts = summed["n"].to_numpy()
    gram = pc.is_null(summed["script"]).to_numpy()
    bucket, owner, count = summed["bucket"].to_numpy()[gram], place[gram], counts[gram]
    order = np.lexsort((owner, bucket))
    bucket, owner, count = bucket[order], owner[order], count[order]
    total = np.bincount(owner, count, len(languages)) + 0.5 * BUCKETS
    words = np.bincount(place[~gram], counts[~gram], len(languages))
    scripts: dict[str, np.ndarray] = {}
    # a language has a script if at least a thousandth of its words do
    for s, k, n in zip(summed["script"].filter(pa.array(~gram)).to_pylist(), place[~gram], counts[~gram], strict=True):
        if n >= max(1, 0.001 * words[k]):
            scripts.setdefault(s, []).append(k)
    return LanguageModel(languages, np.searchsorted(bucket, np.arange(BUCKETS + 1)), owner.astype(np.int32),
                         np.log(2.0 * count + 1).astype(np.float32), np.log(0.5 / total),
                         {s: np.array(sorted(own)) for s, own in scripts.items()})


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best state of every word of consecutive sequences, all sequences a
    step at a time; of equals the first state, and staying before switching."""
    total, k = scores.shape
    if total == 0:
        return np.zeros(0, np.int32)
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    left = lengths[order]
    steps = int(left[0])
    active = np.searchsorted(-left, -np.arange(1, steps + 1), side="right")
    stay = np.ones((total, k), bool)
    source = np.zeros(total, np.int32)
    value = scores[begin[:active[0]]].astype(np.float64)
    last = np.zeros(len(lengths), np.int32)
    for t in range(steps):
        n = int(active[t])
        if t:
            value = value[:n]
            top = value.argmax(axis=1)
            moved = value[np.arange(n), top] - penalty
            keep = value >= moved[:, None]
            at = begin[:n] + t
            stay[at], source[at] = keep, top
            value = np.where(keep, value, moved[:, None]) + scores[at]
        ends = int(active[t + 1]) if t + 1 < steps else 0
        if ends < n:
            last[ends:n] = value[ends:n].argmax(axis=1)
    path = np.zeros(total, np.int32)
    state = last
    for t in range(steps - 1, -1, -1):
        n = int(active[t])
        at = begin[:n] + t
        path[at] = state[:n]
        if t:
            state[:n] = np.where(stay[at, state[:n]], state[:n], source[at])
    return path


def _paths(words: WordTable, texts: list[str]):
    """Per text: letters by language of the path, evidence by language; the
    paths of all words and the number of words of each text."""
    own = [t.split() for t in texts]
    lengths = np.array([len(x) for x in own], np.int64)
    rows = words.rows(own)
    scores = words.scores[rows]
    path = viterbi(scores, lengths)
    k = len(words.model.languages)
    doc = np.repeat(np.arange(len(texts)), lengths)
    held = np.bincount(doc * k + path, words.letters[rows], len(texts) * k).reshape(-1, k)
    evidence = np.stack([np.bincount(doc, scores[:, j], len(texts)) for j in range(k)], axis=1)
    return held, evidence, path, lengths


def label_texts(words: WordTable, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    languages = words.model.languages
    k = len(languages)
    if not k or not texts:
        return ["und"] * len(texts), np.zeros(len(texts))
    held, evidence, _, _ = _paths(words, texts)
    total = held.sum(axis=1)
    # most letters; the better total score decides between equals
    best = np.lexsort((evidence, held), axis=1)[:, -1]
    rows = np.arange(len(texts))
    gap = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    sure = gap[rows, best] / gap.sum(axis=1)
    share = np.divide(held[rows, best], total, out=np.zeros(len(texts)), where=total > 0)
    score = np.clip(share * np.maximum(sure, 1.0 / k), 0.0, 1.0)
    return ([languages[b] if n > 0 else "und" for b, n in zip(best, total, strict=True)],
            np.where(total > 0, score, 0.0))


def kept_texts(words: WordTable, texts: list[str]) -> np.ndarray:
    """Whether each text stays in the corpus (see the module's rule)."""
    if not words.model.languages:
        return np.array([any(map(str.isalpha, t)) for t in texts], bool)
    held, _, _, _ = _paths(words, texts)
    total = held.sum(axis=1)
    return (total > 0) & (held.max(axis=1) >= KEEP_SHARE * total)


def spans(model: LanguageModel, text: str | None) -> list[tuple[int, int, str]]:
    """(first word, end, language) of the spans of one text."""
    if not model.languages or not (text or "").split():
        return []
    _, _, path, _ = _paths(WordTable(model), [text])
    cuts = np.flatnonzero(np.diff(path)) + 1
    edges = [0, *cuts.tolist(), len(path)]
    return [(a, b, model.languages[path[a]]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _slice_bytes(model: LanguageModel) -> int:
    """Text bytes worked on at a time: their words and scores take some 100 MB."""
    return (16 << 20) // max(4, len(model.languages))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = WordTable(shared.value)
        for batch in batches:
            for part in text_slices(batch, 1, _slice_bytes(own.model)):
                labels, score = label_texts(own, texts_of(part, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(labels, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "lang_pred", "score"])

    kind = dict(docs.dtypes)[doc_id]
    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, lang_pred string, score double")


def keep_documents(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``kept_texts`` keeps, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        own = WordTable(shared.value)
        for batch in batches:
            for part in text_slices(batch, at, _slice_bytes(own.model)):
                yield part.filter(pa.array(kept_texts(own, texts_of(part, at)), pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def held_out(column: str = "doc_id"):
    """Whether a row is held out; a null id is not."""
    return F.coalesce(F.pmod(crc_of_id(column), F.lit(5)) == 0, F.lit(False))


def fit_documents(docs: DataFrame) -> LanguageModel:
    """Fit on the rows of the training folds (a null id belongs to none)."""
    return fit(docs.where(F.col("doc_id").isNotNull() & ~held_out()))


def op8_language_id(spark, sf_dir):
    model = fit_documents(documents(spark, sf_dir, "doc_id", "text", "lang"))
    out = predict(documents(spark, sf_dir, "doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
