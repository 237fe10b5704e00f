"""Document quality from a linear-chain CRF over lines.

Every line with a word is labelled good or bad.  Its features are indicators on
the line's own shares (upper case, digits, symbols, punctuation, repeated words,
...) and on its neighbours' shares; the chain adds a weight for each pair of
successive labels.  Forward-backward gives every line's marginal probability of
being good; their mean, weighted by the lines' lengths, is the document's
quality, which a two-parameter logistic curve turns into a score.

The chain is fitted by gradient ascent on a bounded sample of labelled
documents (``MAX_TRAINING_DOCS`` of at most ``MAX_TRAINING_LINES`` lines): a
document's label stands for each of its lines.  Scoring reads every whole text.

Defined results: a null, empty or blank text has no line and scores the share
of good documents in training; with no labelled row that share is one half and
all weights are 0; ids may be null or repeated (row by row; a null id is not
held out); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import column_bytes, crc_of_id, documents, map_arrow, mix64, text_slices, word_hashes
from trellis.plans.tables import stored
from trellis.sources.tables import read_table

MAX_TRAINING_DOCS = 4_000
MAX_TRAINING_LINES = 2_000
#: Lines of all training documents together, about; the features of so many take 40 MB.
MAX_LINES = 400_000
#: Lines whose features are numbers at a time.
BLOCK_LINES = 20_000
ROUNDS = 150
#: A share counts as many indicators as it passes of these.
STEPS = np.array([0.01, 0.03, 0.06, 0.12, 0.25, 0.5])
NEAR_STEPS = np.array([0.06, 0.3])
SHARES = 9
WIDTH = 1 + SHARES * len(STEPS) + 2 * (SHARES * len(NEAR_STEPS) + 1)


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _class("0123456789")
_SYMBOL = _class("#*$%&|<>@^~_=+{}[]\\/`")
_PUNCT = _class("!?.,;:'\"()-")
_SPACE = _class(" \t\n\x0b\x0c\r")


@dataclass
class Lines:
    """Lines with a word of consecutive texts: document, length and features."""
    doc: np.ndarray
    length: np.ndarray
    features: np.ndarray
    counts: np.ndarray


def line_features(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Features of the lines of texts given as bytes and borders."""
    n_docs = len(offsets) - 1
    breaks = np.flatnonzero(data == 10) + 1
    borders = np.unique(np.concatenate([offsets, breaks]))
    borders = borders[borders <= len(data)]
    words, at = word_hashes(data, borders)
    per_line = np.diff(at)
    keep = np.flatnonzero(per_line > 0)
    if len(keep) == 0:
        return Lines(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, WIDTH), np.uint8), np.zeros(n_docs, np.int64))
    start, end = borders[:-1][keep], borders[1:][keep]

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (total[end] - total[start]).astype(np.float64)

    upper, punct = _UPPER[data], _PUNCT[data]
    # upper case of the Latin-1 letters: C3 80 to C3 9E
    upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    twice = np.zeros(len(data), bool)
    twice[1:] = punct[1:] & punct[:-1]
    solid = np.maximum(count(~_SPACE[data] & ((data & 0xC0) != 0x80)), 1)
    own_words = per_line[keep]
    line_of = np.repeat(np.arange(len(keep)), own_words)
    word_line = words                                   # words of empty lines do not exist
    doc = np.searchsorted(offsets, start, side="right") - 1
    seen, first = np.unique(word_line ^ mix64(line_of.astype(np.uint64)), return_index=True)
    distinct = np.bincount(line_of[first], minlength=len(keep))
    cut = np.cumsum(own_words) - own_words
    place = np.arange(len(words)) - np.repeat(cut, own_words)
    with np.errstate(over="ignore"):
        whole = np.add.reduceat(mix64(word_line + mix64(place.astype(np.uint64))), cut)
    _, first = np.unique(whole ^ mix64(doc.astype(np.uint64)), return_index=True)
    repeated = np.ones(len(keep))
    repeated[first] = 0
    mean = solid / own_words
    shares = np.stack([
        count(upper) / solid, count(_DIGIT[data]) / solid, count(_SYMBOL[data]) / solid, count(punct) / solid,
        count(twice) / solid, 1 - distinct / own_words, repeated, np.clip((mean - 4) / 16, 0, 1),
        np.clip(1 - own_words / 20, 0, 1)], axis=1)
    near = (shares[:, :, None] > NEAR_STEPS).reshape(len(keep), -1)
    same = np.concatenate([[False], doc[1:] == doc[:-1]])
    before, after = np.zeros_like(near), np.zeros_like(near)
    before[1:] = near[:-1]
    after[:-1] = near[1:]
    ahead = np.concatenate([same[1:], [False]])
    features = np.concatenate([
        np.ones((len(keep), 1), bool), (shares[:, :, None] > STEPS).reshape(len(keep), -1),
        before & same[:, None], ~same[:, None], after & ahead[:, None], ~ahead[:, None]], axis=1)
    return Lines(doc, (end - start).astype(np.float64), features.view(np.uint8), np.bincount(doc, minlength=n_docs))


@dataclass(frozen=True)
class Crf:
    """``weights`` of the features for good against bad, ``pair[a, b]`` for label
    a followed by b (0 bad, 1 good), the curve's slope and shift, the share of good."""
    weights: np.ndarray
    pair: np.ndarray
    slope: float
    shift: float
    prior: float


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def forward_backward(emission: np.ndarray, counts: np.ndarray, pair: np.ndarray):
    """Marginals of label 1 for every line, and the summed probabilities of each
    label pair.  ``emission`` scores label 1 (label 0 scores 0); all documents
    advance a line at a time, so the time is that of the longest document."""
    n = len(emission)
    order = np.argsort(-counts, kind="stable")
    begin, left = (np.cumsum(counts) - counts)[order], counts[order]
    steps = int(left[0]) if len(left) else 0
    active = np.searchsorted(-left, -np.arange(1, steps + 1), side="right")
    score = np.stack([np.zeros(n), emission], axis=1)
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    for t in range(steps):
        at = begin[:active[t]] + t
        if t:
            prev = alpha[at - 1]
            alpha[at] = np.stack([_log_add(prev[:, 0] + pair[0, s], prev[:, 1] + pair[1, s]) for s in (0, 1)], axis=1)
        alpha[at] += score[at]
    for t in range(steps - 2, -1, -1):
        at = begin[:active[t + 1]] + t
        nxt = beta[at + 1] + score[at + 1]
        beta[at] = np.stack([_log_add(pair[s, 0] + nxt[:, 0], pair[s, 1] + nxt[:, 1]) for s in (0, 1)], axis=1)
    both = alpha + beta
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    expected = np.zeros((2, 2))
    follows = np.ones(n, bool)
    follows[(np.cumsum(counts) - counts)[counts > 0]] = False
    i = np.flatnonzero(follows)
    if len(i):
        z = np.logaddexp(both[i, 0], both[i, 1])
        for a in (0, 1):
            for b in (0, 1):
                expected[a, b] = np.exp(alpha[i - 1, a] + pair[a, b] + score[i, b] + beta[i, b] - z).sum()
    return good, expected


def document_quality(good: np.ndarray, lines: Lines) -> np.ndarray:
    """Length-weighted mean of the marginals; nan for a text without lines."""
    n = len(lines.counts)
    total = np.bincount(lines.doc, weights=lines.length, minlength=n)
    value = np.bincount(lines.doc, weights=lines.length * good, minlength=n)
    return np.divide(value, total, out=np.full(n, np.nan), where=total > 0)


def _blocks(features: np.ndarray):
    """Rows of the 0 and 1 features as numbers, a block at a time."""
    for a in range(0, len(features), BLOCK_LINES):
        yield slice(a, a + BLOCK_LINES), features[a:a + BLOCK_LINES].astype(np.float64)


def _scores(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.empty(len(features))
    for at, x in _blocks(features):
        out[at] = x @ weights
    return out


def _sums(features: np.ndarray, by: np.ndarray) -> np.ndarray:
    out = np.zeros(features.shape[1])
    for at, x in _blocks(features):
        out += x.T @ by[at]
    return out


def fit(features: np.ndarray, counts: np.ndarray, length: np.ndarray, label: np.ndarray, rounds: int = ROUNDS) -> Crf:
    """Penalised maximum likelihood by Adam, classes weighed alike; then the curve."""
    if not len(label):
        return Crf(np.zeros(WIDTH), np.zeros((2, 2)), 1.0, 0.0, 0.5)
    y = np.repeat(label, counts).astype(np.float64)
    doc = np.repeat(np.arange(len(label)), counts)
    lines = Lines(doc, length, features, counts)
    follows = np.zeros(len(y), bool)
    follows[1:] = doc[1:] == doc[:-1]
    i = np.flatnonzero(follows)
    observed = np.zeros((2, 2))
    np.add.at(observed, (y[i - 1].astype(int), y[i].astype(int)), 1)
    theta = np.zeros(WIDTH + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        w, pair = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        good, expected = forward_backward(_scores(features, w), counts, pair)
        grad = np.concatenate([_sums(features, y - good), (observed - expected).ravel()]) / max(1, len(y)) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta + 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    w, pair = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
    good, _ = forward_backward(_scores(features, w), counts, pair)
    prior = float(np.clip(label.mean(), 0.01, 0.99))
    q = _logit(np.nan_to_num(document_quality(good, lines), nan=prior))
    slope, shift = 1.0, 0.0
    for _ in range(200):  # the curve, by damped steps
        p = 1 / (1 + np.exp(-np.clip(slope * q + shift, -50, 50)))
        slope += 0.3 * float(((label - p) * q).mean() / max(1.0, float((q ** 2).mean())))
        shift += 0.3 * float((label - p).mean())
    return Crf(w, pair, max(slope, 0.05), shift, prior)


def _logit(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-6, 1 - 1e-6)
    return np.log(q / (1 - q))


def score_texts(model: Crf, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    lines = line_features(data, offsets)
    good, _ = forward_backward(lines.features @ model.weights, lines.counts, model.pair)
    q = document_quality(good, lines)
    z = model.slope * _logit(np.nan_to_num(q, nan=0.5)) + model.shift
    return np.where(np.isnan(q), model.prior, 1 / (1 + np.exp(-np.clip(z, -50, 50))))


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS,
                  max_lines: int = MAX_TRAINING_LINES, all_lines: int = MAX_LINES) -> DataFrame:
    """Features of the sampled labelled documents: label, counts, length, features.
    The label side of the join holds at most about ``max_docs`` rows, and of the documents
    (repeated ids too) as many stay, by a hash of their features, as hold about ``all_lines``
    lines."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("quality").alias("label")))
    n = known.count()
    if n > max_docs:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < math.ceil((1 << 40) * max_docs / n))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "label")

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 0):
                lines = line_features(*column_bytes(part.column(0)))
                end = np.cumsum(lines.counts)
                ok = [i for i in range(part.num_rows) if 0 < lines.counts[i] <= max_lines]
                own = [slice(end[i] - lines.counts[i], end[i]) for i in ok]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(ok, pa.int64())).cast(pa.int32()),
                     pa.array([int(lines.counts[i]) for i in ok], pa.int64()),
                     pa.array([lines.length[s].tobytes() for s in own], pa.binary()),
                     pa.array([np.packbits(lines.features[s]).tobytes() for s in own], pa.binary())],
                    ["label", "n", "length", "features"])

    made = stored(map_arrow(rows, run, "label int, n long, length binary, features binary"))
    held = made.agg(F.sum("n")).first()[0] or 0
    if held > all_lines:
        made = made.where(F.pmod(F.xxhash64("features", "length"), F.lit(1 << 40)) < math.ceil((1 << 40) * all_lines / held))
    return made


def fit_documents(docs: DataFrame, labels: DataFrame) -> Crf:
    rows = training_rows(docs, labels).toArrow().to_pydict()
    counts = np.array(rows["n"], np.int64)
    # in a fixed order, so that the fit does not depend on the rows' arrival
    order = sorted(range(len(counts)), key=lambda i: (rows["features"][i], rows["length"][i], rows["label"][i]))
    features = [np.unpackbits(np.frombuffer(rows["features"][i], np.uint8))[:counts[i] * WIDTH].reshape(-1, WIDTH) for i in order]
    length = [np.frombuffer(rows["length"][i], np.float64) for i in order]
    return fit(np.concatenate(features) if features else np.zeros((0, WIDTH), np.uint8), counts[order],
               np.concatenate(length) if length else np.zeros(0), np.array([rows["label"][i] for i in order], np.int64))


def score_documents(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id and score: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 1):
                score = score_texts(shared.value, *column_bytes(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double")


def held_out(column: str = "doc_id"):
    return F.coalesce(F.pmod(crc_of_id(column), F.lit(3)) == 1, F.lit(False))


def op5_line_crf(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out())
    out = score_documents(docs, fit_documents(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
