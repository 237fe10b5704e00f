"""Phrase collocations by Toivonen mining: a sample proposes, full passes decide.

1. A share of the documents is mined levelwise: its frequent words, then the phrases
   that can be made of them, word by word longer.  The threshold is lowered, since the
   sample only proposes.
2. A full pass counts the proposed phrases by their text, and their negative border: every
   phrase that is not proposed itself while the two phrases it holds with one word less
   are (a word has none).  The border is never listed, what does not occur needs no
   count, and it is far larger than what is frequent; so it is counted by a
   hash, which never counts too little.
3. A hash of the border that reaches the threshold is a failure: its phrases are proposed
   now, and a further pass counts them by their text, and whatever this adds to the border.
   Passes go on until there is no failure; then, as no phrase is more frequent than
   its parts, every frequent phrase has been counted exactly.

Proposals are handed to tasks as one bit map a level (2 ** ``FILTER_BITS`` bits, whatever
the corpus).  Two phrases that share a bit or a hash only make a pass count more, so
results do not depend on either.  Inside a slice of text words and phrases are numbered,
which compares them exactly; tasks send counts of distinct phrases, never occurrences, and
a common phrase costs one row a task.

Defined results: a null text is empty; a null language is ``und`` (and joins one that is
spelt so); ids are ignored, so repeated rows count as often as they occur; a phrase
never spans two rows or pieces; a text of any length is read in windows that
overlap by the words of a phrase; equal scores and counts rank by the phrase's UTF-8
bytes; an empty table, or one without a frequent phrase, gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trellis.llm.common import (LOWER, WINDOW_BYTES, column_bytes, documents, map_arrow, mix64, text_slices, window_ends,
                                word_array, word_hashes)
from trellis.plans.tables import stored

LEAST = 10
LONGEST = 3
TOP = 2000
#: A longer candidate this often (percent of a phrase's count) stands for it.
COVERED = 50
#: Share of the documents that proposes, and how far its threshold is lowered.
SAMPLE_SHARE = 0.25
LOWERED = 0.8
#: Places in a bit map of proposals, as a power of two.
FILTER_BITS = 25
#: Distinct phrases that a task adds up before it sends them, and sends at a time.
TALLY_ROWS = 700_000
SEND_ROWS = 100_000
#: The ranking keeps ``TOP`` of each of so many parts of a language first.
RANK_PARTS = 64

_U = np.uint64
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


# ------------------------------------------------------------------ words of a slice

@dataclass
class Words:
    """Words of a slice in order: number of each among the distinct (language,
    word) pairs, the piece it stands in, and whether it is new to this window."""

    unit: np.ndarray
    piece: np.ndarray
    new: np.ndarray
    names: pa.Array            # of the units
    langs: pa.Array


def _windows(data: np.ndarray, longest: int):
    """(context, start, end) of windows of one long text; a window's context
    reaches back over the words that a phrase may share with it."""
    for a, b in window_ends(data, _GAP, WINDOW_BYTES):
        context, words = a, 0
        while context > 0 and words < longest - 1 and not _BREAK[data[context - 1]]:
            context -= 1
            if not _GAP[data[context]] and (context == 0 or _GAP[data[context - 1]]):
                words += 1
        yield context, a, b


def _split(data: np.ndarray, offsets: np.ndarray, langs: pa.Array, context: int) -> Words | None:
    """``data`` holds the texts cut by ``offsets``; words that begin before
    ``context`` (bytes) are not new."""
    data = LOWER[data]
    words, start = word_array(data, offsets, _GAP[data])
    if not len(start):
        return None
    row = np.searchsorted(offsets, start, side="right") - 1
    piece = np.cumsum(_BREAK[data], dtype=np.int32 if len(data) < 1 << 31 else np.int64)[start].astype(np.int64) + row
    coded = words.dictionary_encode()
    spoken = langs.dictionary_encode()
    n = len(coded.dictionary)
    key = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row] * n + coded.indices.to_numpy()
    if n * len(spoken.dictionary) <= 16 * len(key) + (1 << 20):     # few languages: number what occurs without a sort
        occurs = np.zeros(n * len(spoken.dictionary), bool)
        occurs[key] = True
        both = np.flatnonzero(occurs)
        number = np.zeros(len(occurs), np.int32)
        number[both] = np.arange(len(both), dtype=np.int32)
        unit = number[key]
    else:
        both, unit = np.unique(key, return_inverse=True)
    return Words(unit.astype(np.int64), piece, start >= context, coded.dictionary.take(pa.array(both % n)),
                 spoken.dictionary.take(pa.array(both // n)))


def _slices(batches, longest: int):
    """Words of the (text, lang) batches, a slice or a window at a time."""
    for batch in batches:
        for part in text_slices(batch, 0):
            data, offsets = column_bytes(part.column(0))
            langs = part.column(1).fill_null("und")
            if part.num_rows == 1 and len(data) > WINDOW_BYTES:
                for context, a, b in _windows(data, longest):
                    if found := _split(data[context:b], np.array([0, b - context]), langs, a - context):
                        yield found
            elif found := _split(data, offsets, langs, 0):
                yield found


# ------------------------------------------------------------------ proposals

def _name_hashes(names: pa.Array, langs: pa.Array) -> np.ndarray:
    """Hashes of the words ``names``, each in its language."""
    own, _ = word_hashes(*column_bytes(names))
    spoken = langs.dictionary_encode()
    by_lang = mix64(np.array([hash_of_text(x) for x in spoken.dictionary.to_pylist()], np.uint64))
    with np.errstate(over="ignore"):
        return mix64(own * _U(3) + by_lang[spoken.indices.to_numpy(zero_copy_only=False)])


def hash_of_text(text: str) -> int:
    """The 64-bit FNV-1a hash of the UTF-8 bytes."""
    out = 1469598103934665603
    for b in text.encode("utf-8", "surrogatepass"):
        out = (out ^ b) * 1099511628211 & 0xFFFFFFFFFFFFFFFF
    return out


def _longer(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of all but its last word and of the last."""
    with np.errstate(over="ignore"):
        return mix64(head * _U(5) + last)


def codes_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash with the number of words, up to 7, in its last bits."""
    return (hashes & ~_U(7)) | _U(k)


@dataclass
class Proposals:
    """A bit map for each level, from one word up; its bit is the first of the hash."""

    maps: dict[int, np.ndarray] = field(default_factory=dict)

    def has(self, level: int, hashes: np.ndarray) -> np.ndarray:
        if level not in self.maps:
            return np.zeros(len(hashes), bool)
        place = hashes >> _U(64 - FILTER_BITS)
        return (self.maps[level][(place >> _U(6)).astype(np.int64)] >> (place & _U(63)) & _U(1)).astype(bool)

    def with_codes(self, rows: DataFrame) -> tuple[Proposals, bool]:
        """These and the phrases of ``code``s, and whether there is any.  What comes to the
        driver is the map itself: 2 ** FILTER_BITS / 64 rows a level at most."""
        place = F.shiftrightunsigned("code", 64 - FILTER_BITS)
        bits = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(code, {64 - FILTER_BITS}) & 63 as int))")
        found = (rows.select(F.col("code").bitwiseAND(7).cast("int").alias("level"), F.shiftright(place, 6).cast("int").alias("slot"), bits.alias("bits"))
                 .groupBy("level", "slot").agg(F.bit_or("bits").alias("bits")).toArrow())
        out = Proposals({k: v.copy() for k, v in self.maps.items()})
        level, slot = found["level"].to_numpy(), found["slot"].to_numpy()
        bits = found["bits"].to_numpy().view(np.uint64)
        for k in np.unique(level).tolist():
            own = out.maps.setdefault(k, np.zeros((1 << FILTER_BITS) // 64, np.uint64))
            own[slot[level == k]] |= bits[level == k]
        return out, found.num_rows > 0


# ------------------------------------------------------------------ counting

def _phrases(words: Words, of_unit: np.ndarray, first: np.ndarray, k: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct phrases of ``k`` words that begin at the words ``first``, each after its
    language and a tab, how often each occurs, and their hashes."""
    units = len(words.names)
    if units ** k < 1 << 63:
        key = words.unit[first]
        for i in range(1, k):
            key = key * units + words.unit[first + i]
        found, n = np.unique(key, return_counts=True)
        own = []
        for _ in range(k):
            found, last = np.divmod(found, units)
            own.append(last)
        own.reverse()
    else:
        rows, n = np.unique(np.stack([words.unit[first + i] for i in range(k)], axis=1), axis=0, return_counts=True)
        own = list(rows.T)
    parts = [words.names.take(pa.array(x)) for x in own]
    text = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if k > 1 else parts[0]
    langs = words.langs.take(pa.array(own[0])).cast(pa.large_string())
    hashes = of_unit[own[0]]
    for x in own[1:]:
        hashes = _longer(hashes, of_unit[x])
    return pc.binary_join_element_wise(langs, text, pa.scalar("\t", pa.large_string())), n, hashes


def _selected(words: Words, of_unit: np.ndarray, levels: tuple[int, ...], now: Proposals, before: Proposals | None):
    """(k, first words of the phrases to count by text, hashes of those of the border), level by
    level.  A phrase is taken up if both phrases that it holds with one word less are
    proposed ``now``; what was counted with the proposals ``before`` is not again."""
    first = np.arange(len(words.unit))
    hashes = of_unit[words.unit]
    old = np.full(len(first), before is not None)       # its parts were proposed before
    last = first
    for k in range(1, max(levels) + 1):
        proposed = now.has(k, hashes)
        known = before.has(k, hashes) if before else np.zeros(len(first), bool)
        if k in levels:
            new = words.new[last]
            yield k, first[proposed & ~(old & known) & new], hashes[~proposed & ~old & new]
        if k == max(levels):
            return
        # phrases that begin next to each other, both proposed, in one piece
        at = np.flatnonzero((first[1:] == first[:-1] + 1) & proposed[1:] & proposed[:-1])
        last = first[at] + k
        inside = words.piece[first[at]] == words.piece[last]
        at, last = at[inside], last[inside]
        old = known[at] & known[at + 1] & old[at] & old[at + 1]
        hashes = _longer(hashes[at], of_unit[words.unit[last]])
        first = first[at]


class _Tally:
    """Counts of a task's phrases, added up over slices before they are sent.  Of texts,
    equal hashes are neighbours in order, and are one only where the texts are."""

    def __init__(self):
        self.texts, self.counts, self.hashes, self.codes, self.code_counts, self.held = [], [], [], [], [], 0

    def add(self, texts: pa.Array, counts: np.ndarray, hashes: np.ndarray) -> None:
        if len(counts):
            self.texts.append(texts)
            self.counts.append(counts.astype(np.int64))
            self.hashes.append(hashes)
            self.held += len(counts)

    def add_codes(self, codes: np.ndarray) -> None:
        codes, counts = np.unique(codes, return_counts=True)
        self.codes.append(codes)
        self.code_counts.append(counts)
        self.held += len(codes) // 2                    # no text

    def _by_text(self):
        texts, counts, hashes = pa.concat_arrays(self.texts), np.concatenate(self.counts), np.concatenate(self.hashes)
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        twin = np.flatnonzero(~new)
        if len(twin):
            same = pc.equal(texts.take(pa.array(order[twin])), texts.take(pa.array(order[twin - 1]))).to_numpy(zero_copy_only=False)
            new[twin[~same]] = True                     # two texts with one hash: both are sent
        start = np.flatnonzero(new)
        return texts.take(pa.array(order[start])), np.add.reduceat(counts, start)

    def spend(self):
        if self.texts:
            texts, sums = self._by_text()
            for a in range(0, len(sums), SEND_ROWS):
                n = pa.array(sums[a:a + SEND_ROWS])
                yield pa.RecordBatch.from_arrays([texts.slice(a, SEND_ROWS).cast(pa.string()), pa.nulls(len(n), pa.int64()), n], ["name", "code", "n"])
        if self.codes:
            codes, counts = np.concatenate(self.codes), np.concatenate(self.code_counts)
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            start = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
            sums = np.add.reduceat(counts, start) if len(codes) else counts
            for a in range(0, len(start), SEND_ROWS):
                n = pa.array(sums[a:a + SEND_ROWS])
                yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.string()), pa.array(codes[start[a:a + SEND_ROWS]].view(np.int64)), n], ["name", "code", "n"])
        self.__init__()


def _count(levels: tuple[int, ...], now: Proposals, before: Proposals | None, totals: bool, longest: int):
    """Arrow function: (name, code, n) of the phrases that ``_selected`` takes: a name (the language,
    a tab and the phrase) or a code of the border.  With ``totals``, each language's number
    of words comes as a phrase of no words."""
    def run(batches):
        tally = _Tally()
        for words in _slices(batches, longest):
            of_unit = _name_hashes(words.names, words.langs)
            for k, first, border in _selected(words, of_unit, levels, now, before):
                if len(first):
                    tally.add(*_phrases(words, of_unit, first, k))
                if len(border):
                    tally.add_codes(codes_of(border, k))
            if totals:
                n = np.bincount(words.unit[words.new], minlength=len(words.names))
                summed = pa.table({"lang": words.langs.cast(pa.large_string()), "n": n}).group_by("lang").aggregate([("n", "sum")])
                langs = summed["lang"].combine_chunks()
                tally.add(pc.binary_join_element_wise(langs, pa.scalar("", pa.large_string()), pa.scalar("\t", pa.large_string())),
                          summed["n_sum"].to_numpy(), mix64(np.array([hash_of_text(x) for x in langs.to_pylist()], np.uint64)))
            if tally.held >= TALLY_ROWS:
                yield from tally.spend()
        yield from tally.spend()
    return run


def _pass(texts: DataFrame, levels: tuple[int, ...], least: int, now: Proposals, before: Proposals | None = None,
          totals: bool = False, longest: int = LONGEST) -> DataFrame:
    """Counts (name, code, n) of what ``_selected`` takes and that occurs ``least`` times at
    least: exact for names, too large at most for codes."""
    shared = texts.sparkSession.sparkContext.broadcast((now, before))

    def run(batches):
        yield from _count(levels, *shared.value, totals, longest)(batches)

    summed = map_arrow(texts, run, "name string, code long, n long").groupBy("name", "code").agg(F.sum("n").alias("n"))
    return stored(summed.where((F.col("n") >= least) | F.col("name").endswith("\t")))


def _named(counted: DataFrame) -> DataFrame:
    """(lang, k, phrase, n) of the rows with a name."""
    phrase = F.substring_index("name", "\t", -1)           # a word holds no tab, a language may
    named = counted.where("name is not null").select(
        F.col("name").substr(F.lit(1), F.length("name") - F.length(phrase) - 1).alias("lang"), phrase.alias("phrase"), "n")
    return named.select("lang", F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("k"), "phrase", "n")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                     share: float = SAMPLE_SHARE) -> DataFrame:
    """(lang, k, phrase, n): every phrase of 1 to ``longest`` words that occurs
    ``least`` times or more in its language, exactly counted, and under k = 0 the
    number of words of each language."""
    if not 1 < longest < 8:
        raise ValueError("phrases have 2 to 7 words")

    def columns(df):
        return df.select(F.col(f"`{text}`").alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"))

    # chosen by the whole row, so that a text that many rows share is sampled like any other
    row = F.xxhash64(*[F.col(f"`{c}`") for c, t in docs.dtypes if "map<" not in t and t != "variant"])
    sample = columns(docs.where(F.pmod(row, F.lit(1 << 20)) < int(share * (1 << 20))))
    texts = columns(docs)
    lowered = max(1, int(LOWERED * least * share))
    now = Proposals()
    for k in range(1, longest + 1):
        now, _ = now.with_codes(_pass(sample, (k,), lowered, now, longest=longest).where("code is not null"))
    levels = tuple(range(1, longest + 1))
    before, found = None, None
    while True:
        counted = _pass(texts, levels, least, now, before, totals=found is None, longest=longest)
        found = _named(counted) if found is None else found.unionByName(_named(counted))
        more, failed = now.with_codes(counted.where("code is not null"))
        if not failed:
            return found
        before, now = now, more


# ------------------------------------------------------------------ scores

def _score(a, left, right):
    """floor(1000000 a a / (l r)) in whole numbers of 38 digits."""
    wide = "cast(%s as decimal(15,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * {wide % a} * {wide % a}) div ({wide % left} * {wide % right})")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP, covered: int = COVERED, share: float = SAMPLE_SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    found = stored(frequent_phrases(docs, text, lang, least, longest, share))
    counts = found.where("k > 0").select("lang", "phrase", F.col("n").alias("f"))
    words = F.split("phrase", " ")
    candidates = found.where("k > 1").select("lang", "phrase", F.col("k"), F.col("n").alias("a"))

    def part(first, length):
        return F.array_join(F.slice(words, first, length), " ")

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("head"),
                       part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    scored = cuts.select("lang", "phrase", "a", F.struct(_score("a", "l", "r").alias("score"), "cut", "l", "r").alias("s"))
    scored = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("s").alias("s"))
    inner = candidates.where("k > 2").select(
        "lang", "a", words.alias("w"), "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("length"))
    inner = inner.select("lang", "a", "w", "length", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("length") + 1)).alias("first"))
    inner = (inner.select("lang", F.array_join(F.slice("w", F.col("first"), F.col("length")), " ").alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    left = (scored.join(inner, ["lang", "phrase"], "left")
            .where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
            .select("lang", "phrase", "a", "s.score", "s.l", "s.r"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part_of = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    few = (left.withColumn("part", part_of)
           .withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top))
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = found.where("k = 0").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def oracle_sql(least: int = LEAST, top: int = TOP, covered: int = COVERED) -> str:
    """DuckDB SQL for phrases of 2 and 3 words."""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT rid, lang, string_split_regex(t, '[.,;:!?\x0A-\x0D]') AS ps FROM d),
q AS (SELECT rid, lang, unnest(range(1, len(ps) + 1)) AS pid, unnest(ps) AS piece FROM p),
e AS (SELECT rid, lang, pid, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM q),
w AS (SELECT rid, lang, pid, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS x FROM e),
g AS (SELECT lang, x, lead(x, 1) OVER o AS y, lead(x, 2) OVER o AS z FROM w WINDOW o AS (PARTITION BY rid, pid ORDER BY i)),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
f1 AS (SELECT lang, x, count(*) AS f FROM g GROUP BY lang, x HAVING count(*) >= {least}),
f2 AS (SELECT lang, x, y, count(*) AS f FROM g WHERE y IS NOT NULL GROUP BY lang, x, y HAVING count(*) >= {least}),
f3 AS (SELECT lang, x, y, z, count(*) AS f FROM g WHERE z IS NOT NULL GROUP BY lang, x, y, z HAVING count(*) >= {least}),
c AS (SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.f AS a, 1 AS cut, u.f AS l, v.f AS r
      FROM f2 JOIN f1 u ON u.lang = f2.lang AND u.x = f2.x JOIN f1 v ON v.lang = f2.lang AND v.x = f2.y
      UNION ALL
      SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, 1, u.f, v.f
      FROM f3 JOIN f1 u ON u.lang = f3.lang AND u.x = f3.x JOIN f2 v ON v.lang = f3.lang AND v.x = f3.y AND v.y = f3.z
      UNION ALL
      SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, 2, u.f, v.f
      FROM f3 JOIN f2 u ON u.lang = f3.lang AND u.x = f3.x AND u.y = f3.y JOIN f1 v ON v.lang = f3.lang AND v.x = f3.z),
s AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM c),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS k FROM s) WHERE k = 1),
m AS (SELECT lang, phrase, max(f) AS longer FROM (
      SELECT lang, x || ' ' || y AS phrase, f FROM f3 UNION ALL SELECT lang, y || ' ' || z, f FROM f3) GROUP BY lang, phrase),
h AS (SELECT b.* FROM b LEFT JOIN m ON b.lang = m.lang AND b.phrase = m.phrase
      WHERE m.longer IS NULL OR 100 * m.longer < {covered} * b.a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM h)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score FROM r JOIN n ON n.lang = r.lang WHERE r.rank <= {top}"""


def op13_collocations(spark, sf_dir):
    return collocations(documents(spark, sf_dir, "doc_id", "text", "lang"))
