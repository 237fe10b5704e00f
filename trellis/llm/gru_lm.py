"""Language-model scores of whole documents by a gated recurrent network in numpy.

1. Every word of the training documents is counted.  The most frequent words (at
   most ``HEAD``, by a cut on the count) are broadcast; the counts of all others stay
   a table, which documents' rarer words are joined with.
2. The network knows the ``VOCABULARY`` most frequent of them.  They are sorted by
   frequency into ``CLASSES`` classes of like root frequency; the output is factored into
   the class and the word within its class.  All other words form one more class,
   in which a word has its add-one share of that class's occurrences, so that the
   probabilities of all words, seen or not, sum to one.
3. Training goes once over all training documents, in rounds that take growing
   shares of them (by a hash of the row).  In a round every task trains its own
   copy from the common weights on all its documents (streams of documents side by
   side, long ones in segments; backpropagation through windows of ``STEPS`` words, the
   state carried from window to window, Adagrad); then weights and step sizes are averaged by tokens.
4. Scoring lays whole documents end to end on parallel streams.  A document starts from
   the zero state and carries its state through all of its windows to its end mark.

Tasks send one copy of the weights a round (some 2.3 MB, averaged in two steps so that
no row gathers all tasks); the driver holds one copy.

Defined results: a null text is empty and has one token, its end; words of any script
count as they are but for A to Z in lower case; a null id is in training; ids may be
repeated (row by row); without training documents every base probability is 1 and the
network is the untrained one; an empty table gives an empty result; further columns are
ignored.  A text of any length is read in windows; a very long one takes its time on
one stream, since its state has to be carried.  Weights depend on how Spark deals
the rows to tasks; the counts do not.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import (IS_SPACE, LOWER, WINDOW_BYTES, column_bytes, crc_of_id, documents, gathered,
                                map_arrow, text_slices, window_ends, word_array)
from trellis.plans.tables import stored

HEAD = 1 << 18
VOCABULARY = 4096
CLASSES = 32
WIDTH = 16                  # of the state and of a word's input vector
STEPS = 32
STREAMS = 384
RATE = 0.05
#: Words of a document that training reads from one starting state; scoring carries the state
#: through whole documents.
SEGMENT = 1024
#: Borders between the rounds, as shares of the training documents.
ROUNDS = (0.0, 1 / 16, 5 / 16, 1.0)
#: Text bytes that are counted, or laid on streams for scoring, together; and for training.
SLICE = 16 << 20
TRAIN_SLICE = 8 << 20
#: Weights are summed in blocks of so many, of so many tasks at a time.
BLOCK = 1 << 14
SALTS = 16
END = ""                    # no word is empty

_F = np.float32


# ------------------------------------------------------------------ words and counts

def _documents(column: pa.Array):
    """Words of each slice of a text column: (first row, words, row of each word)."""
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    base = 0
    for part in text_slices(batch, 0, SLICE):
        data, offsets = column_bytes(part.column(0))
        if part.num_rows == 1 and len(data) > WINDOW_BYTES:
            found = []
            for a, b in window_ends(data, IS_SPACE, WINDOW_BYTES):
                low = LOWER[data[a:b]]
                found.append(word_array(low, np.array([0, b - a]), IS_SPACE[low])[0])
            words = pa.chunked_array(found, pa.large_string())
            yield base, part.num_rows, words, np.zeros(len(words), np.int64)
        else:
            low = LOWER[data]
            words, start = word_array(low, offsets, IS_SPACE[low])
            yield base, part.num_rows, words, np.searchsorted(offsets, start, side="right") - 1
        base += part.num_rows


def _counts(batches):
    """(word, n) of each slice, and its documents under the end mark."""
    for batch in gathered(batches, 0, SLICE):
        for _, rows, words, _ in _documents(batch.column(0)):
            found = pc.value_counts(words)
            names = found.field("values").cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([names, pa.array([END], pa.string())]),
                 pa.concat_arrays([found.field("counts"), pa.array([rows], pa.int64())])], ["word", "n"])


@dataclass
class Vocabulary:
    """Training counts: all words' totals, the head's words and counts (falling, so
    that the network's words come first), and the network's classes."""

    total: int
    distinct: int
    words: pa.Array
    counts: np.ndarray
    known: int = 0                                  # the first so many are the network's
    starts: np.ndarray = field(default=None)        # borders of the classes among them

    def __post_init__(self):
        self.known = min(VOCABULARY, len(self.counts))
        root = np.sqrt(self.counts[:self.known].astype(float))
        kind = (np.cumsum(root) - root / 2) / max(root.sum(), 1) * CLASSES
        self.starts = np.searchsorted(kind.astype(np.int64), np.arange(CLASSES + 1))
        inside = int(self.counts[:self.known].sum())
        #: Add-one denominator of the words outside the network, one unseen word included.
        self.rest = self.total - inside + self.distinct - self.known + 1

    def place(self, words, known: bool = False) -> np.ndarray:
        """Index of each word in the head, or among the network's words, -1 for the others."""
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        coded = words.dictionary_encode()
        at = pc.index_in(coded.dictionary.cast(pa.large_string()), value_set=self.words.slice(0, self.known) if known else self.words).fill_null(-1).to_numpy()
        return (at[coded.indices.to_numpy()] if len(coded) else np.zeros(0)).astype(np.int32)


def count_words(texts: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """The stored table (word, n) of all words and the end, and the vocabulary."""
    counts = stored(map_arrow(texts, _counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    # the cut: words by an eighth of their count's binary order, a few hundred rows
    order = F.floor(8 * F.log2(F.col("n").cast("double"))).cast("int")
    sizes = counts.groupBy(order.alias("o")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    cut, held = math.inf, 0
    for r in sorted(sizes, key=lambda r: -r["o"]):
        held += r["words"]
        if held > HEAD:
            break
        cut = r["o"]
    # the end mark is always in the head: documents hand on their words, not it
    head = counts.where((order >= F.lit(1 << 30 if cut is math.inf else cut)) | (F.col("word") == END)).toArrow()
    rows = np.lexsort((head["word"].to_numpy(zero_copy_only=False), -head["n"].to_numpy()))
    words = head["word"].cast(pa.large_string()).combine_chunks().take(pa.array(rows))
    return counts, Vocabulary(sum(r["n"] for r in sizes), sum(r["words"] for r in sizes), words, head["n"].to_numpy()[rows])


# ------------------------------------------------------------------ the network

def _shapes(known: int) -> dict[str, tuple[int, ...]]:
    return {"inputs": (known + 1, WIDTH), "x": (WIDTH, 3 * WIDTH), "h": (WIDTH, 3 * WIDTH), "bias": (3 * WIDTH,),
            "classes": (WIDTH, CLASSES + 1), "class_bias": (CLASSES + 1,), "words": (known, WIDTH), "word_bias": (known,)}


def _split(flat: np.ndarray, known: int) -> dict[str, np.ndarray]:
    """Views of one flat array of weights by name."""
    out, at = {}, 0
    for name, shape in _shapes(known).items():
        n = math.prod(shape)
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def initial(vocabulary: Vocabulary) -> np.ndarray:
    """Random inputs and gates; outputs that give every word its training share."""
    known = vocabulary.known
    flat = np.zeros(sum(math.prod(s) for s in _shapes(known).values()), _F)
    w = _split(flat, known)
    random = np.random.default_rng(17)
    for name in ("inputs", "x", "h"):
        w[name][:] = random.normal(0, 1 / math.sqrt(WIDTH), w[name].shape)
    for c in range(CLASSES):
        w["class_bias"][c] = math.log(vocabulary.counts[vocabulary.starts[c]:vocabulary.starts[c + 1]].sum() + 1e-3)
    w["class_bias"][CLASSES] = math.log(vocabulary.rest)
    w["class_bias"] -= w["class_bias"].max()
    w["word_bias"][:] = np.log(vocabulary.counts[:known] / max(1, vocabulary.counts[:1].sum()))
    return flat


def _softmax(x: np.ndarray, bound: float) -> np.ndarray:
    """In place; returns the log of what each row's exponentials sum to.  Where no value
    can exceed ``bound`` in size and that is small, none needs to be shifted first."""
    kept = None if bound < 80 else x.max(axis=1, keepdims=True)
    if kept is not None:
        x -= kept
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], _F)
    x /= total[:, None]
    return np.log(total) if kept is None else np.log(total) + kept[:, 0]


class Network:
    """One window at a time over streams; with ``steps`` (Adagrad's sums of squares)
    it can also train.  States and gates lie as (step, unit, stream), so that a gate is
    one block of memory; arrays are used again from window to window."""

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray, steps: np.ndarray | None = None):
        self.known, self.starts = vocabulary.known, vocabulary.starts
        self.class_of = np.append(np.repeat(np.arange(CLASSES, dtype=np.int8), np.diff(self.starts)), np.int8(CLASSES))
        self.flat = flat
        self.w = _split(flat, self.known)
        self.s = None if steps is None else _split(steps, self.known)
        self.steps = steps
        self.rooms: dict[str, np.ndarray] = {}
        self._set_bounds()

    def _set_bounds(self) -> None:
        """States lie between -1 and 1, so an output is at most its weights' sum of sizes."""
        w = self.w
        self.class_bound = float((np.abs(w["classes"]).sum(axis=0) + np.abs(w["class_bias"])).max())
        sizes = np.abs(w["words"]) @ np.ones(WIDTH, _F) + np.abs(w["word_bias"])
        self.word_bounds = [float(sizes[a:b].max(initial=0)) for a, b in zip(self.starts[:-1], self.starts[1:], strict=True)]

    def _room(self, name: str, *shape: int) -> np.ndarray:
        n = math.prod(shape)
        if name not in self.rooms or len(self.rooms[name]) < n:
            self.rooms[name] = np.empty(n, _F)
        return self.rooms[name][:n].reshape(shape)

    def _step(self, name: str, gradient: np.ndarray, rows=slice(None)) -> None:
        sums = self.s[name][rows] + gradient * gradient
        self.s[name][rows] = sums
        gradient *= RATE / np.sqrt(sums)
        self.w[name][rows] -= gradient

    def window(self, state: np.ndarray, before: np.ndarray, target: np.ndarray, fresh: np.ndarray, used: np.ndarray,
               train: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability (natural; of the class for words outside the network) of
        ``target`` after ``before``, both steps x streams of indexes up to ``known`` (the
        others); ``fresh`` marks steps that start a document, ``used`` those that
        exist.  ``state`` is unit x stream.  Returns it and the next state."""
        steps, streams = target.shape
        w, n = self.w, WIDTH
        x = w["inputs"].take(before.ravel(), axis=0).reshape(steps, streams, n)
        stays = (~fresh).astype(_F)
        resets = fresh.any(axis=1).tolist()
        by_x, by_h = np.ascontiguousarray(w["x"].T), np.ascontiguousarray(w["h"].T)
        bias = w["bias"][:, None]
        kept = steps if train else 1                    # scoring needs no step but the last
        went, pulled = self._room("went", kept, n, streams), self._room("pulled", kept, 3 * n, streams)
        gate, new = self._room("gate", kept, 2 * n, streams), self._room("new", kept, n, streams)
        hidden, fed = self._room("hidden", steps, n, streams), self._room("fed", 3 * n, streams)
        for t in range(steps):
            k = t if train else 0
            h, u, zr, c = went[k], pulled[k], gate[k], new[k]
            if resets[t]:
                np.multiply(state, stays[t], out=h)
            else:
                h[:] = state
            np.matmul(by_x, x[t].T, out=fed)
            fed += bias
            np.matmul(by_h, h, out=u)
            np.add(fed[:2 * n], u[:2 * n], out=zr)
            np.negative(zr, zr)
            np.exp(zr, zr)
            zr += 1
            np.reciprocal(zr, zr)
            np.multiply(zr[n:], u[2 * n:], out=c)
            c += fed[2 * n:]
            np.tanh(c, c)
            state = hidden[t]
            np.subtract(c, h, out=state)
            state *= zr[:n]
            state += h
        state = state.copy()
        # output: class, then word within the class, class by class
        flat = self._room("flat", steps, streams, n)
        flat[:] = hidden.transpose(0, 2, 1)
        at = np.flatnonzero(used.ravel())
        kind = self.class_of[target.ravel()[at]]
        order = np.argsort(kind, kind="stable")
        at, kind = at[order], kind[order]
        out, word = flat.reshape(-1, n).take(at, axis=0), target.ravel()[at]
        cuts = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
        rows = np.arange(len(at))
        p = self._room("classes", len(at), CLASSES + 1)
        np.matmul(out, w["classes"], out=p)
        p += w["class_bias"]
        log_p = p[rows, kind]
        log_p -= _softmax(p, self.class_bound)
        if train:
            p[rows, kind] -= 1
            back = p @ w["classes"].T
            by_class = out.T @ p, np.ones(len(at), _F) @ p
            by_word, by_word_bias = np.zeros_like(w["words"]), np.zeros_like(w["word_bias"])
        for c in range(CLASSES):
            a, b = self.starts[c], self.starts[c + 1]
            i, j = cuts[c], cuts[c + 1]
            if i == j or b - a < 2:
                continue
            held, own, member = w["words"][a:b], out[i:j], word[i:j] - a
            q = self._room("words", j - i, b - a)
            np.matmul(own, held.T, out=q)
            q += w["word_bias"][a:b]
            log_p[i:j] += q[rows[:j - i], member]
            log_p[i:j] -= _softmax(q, self.word_bounds[c])
            if train:
                q[rows[:j - i], member] -= 1
                back[i:j] += q @ held
                np.matmul(q.T, own, out=by_word[a:b])
                by_word_bias[a:b] = np.ones(j - i, _F) @ q
        result = np.zeros(steps * streams, np.float64)
        result[at] = log_p
        if train:
            by_out = self._room("by_out", steps * streams, n)
            by_out[:] = 0
            by_out[at] = back
            self._back(by_out.reshape(steps, streams, n), stays, before, x, went, gate, new, pulled, by_x, by_h)
            self._step("classes", by_class[0])
            self._step("class_bias", by_class[1])
            self._step("words", by_word)
            self._step("word_bias", by_word_bias)
            self._set_bounds()
        return result.reshape(steps, streams), state

    def _back(self, by_out, stays, before, x, went, gate, new, pulled, by_x, by_h) -> None:
        """Backpropagation through the window; ``by_out`` is the loss by each state."""
        n = WIDTH
        steps, streams = stays.shape
        lost = self._room("flat", steps, n, streams)
        lost[:] = by_out.transpose(0, 2, 1)
        in_x, in_h = self._room("in_x", steps, 3 * n, streams), self._room("in_h", steps, 3 * n, streams)
        later, one = np.zeros((n, streams), _F), np.empty((n, streams), _F)
        slope = np.empty((2 * n, streams), _F)
        back = np.ascontiguousarray(by_h.T)
        for t in range(steps - 1, -1, -1):
            d, zr, c, gx, gh = lost[t], gate[t], new[t], in_x[t], in_h[t]
            d += later
            dc = gx[2 * n:]
            np.subtract(c, went[t], out=one)
            np.multiply(d, one, out=gx[:n])
            np.multiply(d, zr[:n], out=one)             # through the update gate
            np.multiply(c, c, out=c)
            np.subtract(1, c, out=c)
            np.multiply(c, one, out=dc)
            np.multiply(dc, zr[n:], out=gh[2 * n:])
            np.multiply(dc, pulled[t, 2 * n:], out=gx[n:2 * n])
            np.subtract(1, zr, out=slope)
            slope *= zr
            gx[:2 * n] *= slope
            gh[:2 * n] = gx[:2 * n]
            np.matmul(back, gh, out=later)
            later += d
            later -= one
            later *= stays[t]
        by_input = np.matmul(in_x.transpose(0, 2, 1), by_x).reshape(-1, n)
        tokens = before.ravel()
        order = np.argsort(tokens, kind="stable")
        tokens = tokens[order]
        first = np.flatnonzero(np.diff(tokens, prepend=-1))
        self._step("inputs", np.add.reduceat(by_input.take(order, axis=0), first), tokens[first])
        self._step("x", np.matmul(in_x, x).sum(axis=0).T)
        self._step("bias", in_x.sum(axis=(0, 2)))
        self._step("h", np.matmul(in_h, went.transpose(0, 2, 1)).sum(axis=0).T)


@dataclass
class Streams:
    """Documents end to end on parallel streams, the longest stream first: words
    (steps x streams), the document of each, and where one starts."""

    words: np.ndarray
    owner: np.ndarray
    lengths: np.ndarray


def lay_out(words: np.ndarray, lengths: np.ndarray, streams: int) -> Streams:
    """The longest document goes to the shortest stream.  ``words`` holds the
    documents one after another."""
    begin = np.cumsum(lengths) - lengths
    heap = [(0, s) for s in range(min(streams, len(lengths)))]
    place = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable").tolist():
        size, s = heapq.heappop(heap)
        place[s].append(d)
        heapq.heappush(heap, (size + int(lengths[d]), s))
    total = np.array([lengths[own].sum() for own in place])
    order = np.argsort(-total, kind="stable")
    steps = int(total.max(initial=0))
    laid = np.full((len(place), steps), -1, np.int32)
    owner = np.full((len(place), steps), -1, np.int32)
    for i, s in enumerate(order.tolist()):
        own = np.array(place[s])
        laid[i, :total[s]] = np.concatenate([words[begin[d]:begin[d] + lengths[d]] for d in own])
        owner[i, :total[s]] = np.repeat(own, lengths[own])
    return Streams(laid.T, owner.T, total[order])


def segments(lengths: np.ndarray, most: int = SEGMENT) -> np.ndarray:
    """Lengths of the parts that documents are cut into, ``most`` words at most."""
    parts = -(-lengths // most)
    out = np.full(parts.sum(), most, lengths.dtype)
    out[np.cumsum(parts) - 1] = lengths - (parts - 1) * most
    return out


def run_network(network: Network, streams: Streams, train: bool = False) -> np.ndarray:
    """Natural log-probability of every laid word (steps x streams)."""
    steps, n = streams.words.shape
    out = np.zeros((steps, n))
    known = network.known
    words = np.where((streams.words >= 0) & (streams.words < known), streams.words, known).astype(np.int16)
    start = np.ones((steps, n), bool)
    start[1:] = streams.owner[1:] != streams.owner[:-1]
    end = known                                     # a document begins after the others' input
    before = np.full((steps, n), end, words.dtype)
    before[1:] = np.where(start[1:], end, words[:-1])
    state = np.zeros((WIDTH, n), _F)
    a = 0
    while a < steps:
        live = int(np.searchsorted(-streams.lengths, -a, side="left"))
        # where few streams are left, a window takes more steps
        b = min(a + min(max(STEPS, STEPS * STREAMS // live), 16 * STEPS), steps)
        part = (slice(a, b), slice(0, live))
        out[part], state = network.window(state[:, :live], before[part], words[part], start[part], streams.owner[part] >= 0, train)
        a = b
    return out


def laid_documents(vocabulary: Vocabulary, column: pa.Array, known: bool = False):
    """Per slice: first row, number of rows, words' places in the head or among the
    network's words (each document's end mark last), words per document, and the words
    themselves with their rows."""
    end = vocabulary.place(pa.array([END], pa.large_string()), known)[0]
    for base, rows, words, row in _documents(column):
        own = vocabulary.place(words, known)
        lengths = np.bincount(row, minlength=rows) + 1
        places = np.full(len(own) + rows, end, np.int32)
        places[np.arange(len(own)) + row] = own
        yield base, rows, places, lengths, words, row, own


# ------------------------------------------------------------------ training

def _trained(shared):
    """Arrow function: one task's weights after its documents, in blocks."""
    def run(batches):
        vocabulary, flat, steps = shared.value
        network = Network(vocabulary, flat.copy(), steps.copy())
        tokens = 0
        for batch in gathered(batches, 0, TRAIN_SLICE):
            for _, _, places, lengths, *_ in laid_documents(vocabulary, batch.column(0), known=True):
                tokens += len(places)
                run_network(network, lay_out(places, segments(lengths), STREAMS), train=True)
        if tokens:
            both = np.concatenate([network.flat, network.steps]).astype(np.float64) * tokens
            blocks = [both[a:a + BLOCK] for a in range(0, len(both), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([TaskContext.get().partitionId()] * len(blocks), pa.int32()),
                 pa.array([tokens] * len(blocks), pa.int64()), pa.array(blocks, pa.list_(pa.float64()))],
                ["block", "task", "tokens", "sums"])
    return run


def _summed(key, table):
    rows = np.argsort(table.column("task").to_numpy(), kind="stable")
    sums = [table.column("sums").combine_chunks()[int(i)].values.to_numpy() for i in rows]
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([min(table.column("task").to_pylist())], pa.int32()),
                     "tokens": pa.array([sum(table.column("tokens").to_pylist())], pa.int64()),
                     "sums": pa.array([np.sum(sums, axis=0)], pa.list_(pa.float64()))})


def train(texts: DataFrame, share: str, vocabulary: Vocabulary) -> np.ndarray:
    """Weights after one pass over ``texts`` (text, and ``share`` from 0 to 1)."""
    flat = initial(vocabulary)
    steps = np.full(len(flat), 0.01, _F)
    kind = "block int, task int, tokens long, sums array<double>"
    for low, high in zip(ROUNDS[:-1], ROUNDS[1:], strict=True):
        shared = texts.sparkSession.sparkContext.broadcast((vocabulary, flat, steps))
        own = texts.where((F.col(share) >= low) & (F.col(share) < high)).select("text")
        parts = map_arrow(own, _trained(shared), kind)
        some = parts.groupBy("block", F.pmod("task", F.lit(SALTS)).alias("salt")).applyInArrow(_summed, kind)
        rows = some.groupBy("block").applyInArrow(_summed, kind).orderBy("block").toArrow()
        if rows.num_rows:
            both = np.concatenate([x.values.to_numpy() / n for x, n in zip(rows["sums"].combine_chunks(), rows["tokens"].to_pylist(), strict=True)])
            flat, steps = both[:len(flat)].astype(_F), both[len(flat):].astype(_F)
        shared.unpersist()
    return flat


# ------------------------------------------------------------------ scoring

def _scored(shared):
    """Arrow function over (rid, id, text): counts and sums of the head's words, the
    network's score, and the other words with their counts."""
    def run(batches):
        vocabulary, flat = shared.value
        network = Network(vocabulary, flat)
        log_count = np.append(np.log10(vocabulary.counts + 1.0), 0.0)
        rest = math.log10(vocabulary.rest)
        for batch in gathered(batches, 2, SLICE):
            for base, rows, places, lengths, words, row, own in laid_documents(vocabulary, batch.column(2)):
                doc = np.repeat(np.arange(rows), lengths)
                streams = lay_out(places, lengths, STREAMS)
                laid = streams.owner >= 0
                log_p = run_network(network, streams)[laid] / math.log(10)
                score = np.bincount(streams.owner[laid], log_p, rows)
                outside = (places < 0) | (places >= vocabulary.known)
                score += np.bincount(doc[outside], log_count[places[outside]] - rest, rows)
                base_sum = np.bincount(doc, log_count[places], rows)
                n_known = np.bincount(doc[places >= 0], minlength=rows)
                if isinstance(words, pa.ChunkedArray):
                    words = words.combine_chunks()
                rare = np.flatnonzero(own < 0)
                found = pa.table({"row": row[rare], "word": words.take(pa.array(rare))}).group_by(["row", "word"], use_threads=False).aggregate([([], "count_all")]).sort_by("row")
                edges = np.searchsorted(found["row"].to_numpy(), np.arange(rows + 1)).astype(np.int32)
                pairs = pa.StructArray.from_arrays([found["word"].combine_chunks().cast(pa.string()), found["count_all"].combine_chunks()], ["word", "n"])
                part = batch.slice(base, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lengths, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base_sum),
                     pa.array(score), pa.ListArray.from_arrays(pa.array(edges), pairs)],
                    ["rid", "doc_id", "n_tokens", "n_known", "base_sum", "lm_sum", "rare"])
    return run


def score(docs: DataFrame, held_out, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row
    per document, learning from those for which ``held_out`` (a Column) is false."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{doc_id}`").alias("doc_id"),
                       F.col(f"`{text}`").alias("text"), held_out.alias("held_out"),
                       (F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), F.lit(1 << 20)) / (1 << 20)).alias("share"))
    training = rows.where(~F.col("held_out"))
    counts, vocabulary = count_words(training.select("text"))
    weights = train(training.select("text", "share"), "share", vocabulary)
    shared = spark.sparkContext.broadcast((vocabulary, weights))
    kind = dict(docs.dtypes)[doc_id]
    found = stored(map_arrow(
        rows.select("rid", "doc_id", "text"), _scored(shared), f"rid long, doc_id {kind}, n_tokens long, n_known long, base_sum double, lm_sum double, "
                                    "rare array<struct<word: string, n: long>>"))
    # the words outside the head: their counts by a join, one row for each word of a document
    rare = found.select("rid", F.explode("rare").alias("r")).select("rid", F.col("r.word").alias("word"), F.col("r.n").alias("times"))
    more = (rare.join(counts, "word").groupBy("rid")
            .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("seen")))
    unit = math.log10(vocabulary.total + vocabulary.distinct + 1)
    extra = F.coalesce("more", F.lit(0.0))
    return found.join(more, "rid", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base_sum") + extra - F.col("n_tokens") * unit).alias("base_score"), (F.col("lm_sum") + extra).alias("score"))


def held_out(column: str = "doc_id"):
    """Whether a row is held out; a null id is not."""
    return F.coalesce(F.pmod(crc_of_id(column), F.lit(7)) == 2, F.lit(False))


def op12_gru_scores(spark, sf_dir):
    out = score(documents(spark, sf_dir, "doc_id", "text"), held_out())
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
