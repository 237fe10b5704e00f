"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) from counts of the text.  A
two-class model with one accuracy per rule and class is fitted to the votes of
all documents by expectation-maximisation: the votes are first summed to a
table of vote patterns (at most 3**8 rows, whatever the corpus), and each EM
step is one small aggregation of that table.  A document is kept if its
posterior probability of being good is at least one half; no rule alone decides.

Defined results: a null or empty text has no words, all counts 0; null ids and
repeated rows stay, row by row; an empty table gives an empty result; further
columns are ignored (``signals``) or returned untouched (``keep_documents``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import documents
from trellis.plans.tables import stored

RULES = ("length", "symbols", "dup_lines", "repeats", "word_length", "upper", "marks", "symbol_share")
#: EM starts from these: (good vote given good, bad vote given bad, share of good).
START = (0.99, 0.3, 0.8)
STEPS = 12
_LEAST = 0.001


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(windows: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.  Sorts (window,
    place) pairs; equal neighbours are repeats."""
    def covered(places: Column) -> Column:
        one = F.transform(places, lambda p: p + 1)
        two = F.transform(places, lambda p: p + 2)
        return F.size(F.array_distinct(F.concat(places, one, two)))

    def repeated(s: Column) -> Column:
        def twin(x, k):
            return (((k > 0) & (F.get(s, k - 1)["t"] == x["t"]))
                    | F.coalesce(F.get(s, k + 1)["t"] == x["t"], F.lit(False)))
        return _let(F.transform(F.filter(s, twin), lambda x: x["p"]), covered)

    pairs = F.transform(windows, lambda t, p: F.struct(t.alias("t"), p.alias("p")))
    return _let(F.sort_array(pairs), repeated)


def _words(t: Column) -> Column:
    """Runs of characters other than space and \\t \\n \\v \\f \\r: splitting at one
    literal character is several times as fast as a regular expression."""
    for blank in "\t\n\x0b\f\r":
        t = F.replace(t, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(t, " "), "")


def signals(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts of every whole text: the ``keep`` columns, then n_words,
    word_chars, n_symbols, n_lines (lines with a word), n_dup_lines,
    n_repeat_words, n_upper, n_marks (ASCII punctuation and digits; all long).
    Windows are compared by a 64-bit hash of their three words."""
    t = F.coalesce(F.col(text), F.lit(""))
    # a line with a word: blanks, then a character that is none, to the line's end
    line = r"(?md)^[\x20\x09\x0B-\x0D]*+[^\x20\x09-\x0D][^\n]*"
    step1 = docs.select(
        *[F.col(k) for k in keep],
        _words(t).alias("_words"),
        F.regexp_extract_all(t, F.lit(line), F.lit(0)).alias("_lines"),
        F.regexp_replace(t, r"[^\p{Lu}\p{Nd}!-/:-@\[-`{-~]+", "").alias("_marks"))
    words = F.col("_words")
    window = _let(words, lambda ws: F.transform(
        ws, lambda w, k: F.xxhash64(w, F.get(ws, k + 1), F.get(ws, k + 2))))
    n_upper = F.length(F.regexp_replace("_marks", r"\P{Lu}+", ""))
    step2 = step1.select(
        *[F.col(k) for k in keep],
        F.size(words).alias("n_words"),
        F.length(F.array_join(words, "")).alias("word_chars"),
        F.length(F.regexp_replace("_marks", r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        n_upper.alias("n_upper"), (F.length("_marks") - n_upper).alias("n_marks"),
        F.slice(window, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))).alias("_windows"))
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    step3 = step2.withColumn("n_repeat_words", F.when(some, _repeat_words(F.col("_windows"))).otherwise(0))
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks")
    return step3.select(*[F.col(k) for k in keep], *[F.col(c).cast("long").alias(c) for c in names])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: Each rule as SQL text over the counts: (votes bad if, else votes good if).
VOTES = {
    "length": ("n_words < 30", "n_words >= 60"),
    "symbols": ("20 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    "dup_lines": ("2 * n_dup_lines > n_lines", "n_lines >= 2 and 5 * n_dup_lines <= n_lines"),
    "repeats": ("100 * n_repeat_words > 40 * n_words", "100 * n_repeat_words <= 10 * n_words"),
    "word_length": ("word_chars < 2 * n_words or word_chars > 14 * n_words",
                    "word_chars >= 3 * n_words and word_chars <= 12 * n_words"),
    "upper": ("100 * n_upper > 40 * (word_chars - n_marks)", "100 * n_upper <= 20 * (word_chars - n_marks)"),
    "symbol_share": ("10 * n_symbols > 4 * n_marks", "10 * n_symbols <= n_marks"),
    "marks": ("100 * n_marks > 18 * word_chars", "100 * n_marks <= 8 * word_chars"),
}


def _vote(rule: str) -> Column:
    bad, good = VOTES[rule]
    return F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)


@dataclass(frozen=True)
class RuleModel:
    """Share of good documents and, by rule, P(good vote | good, voted) and
    P(bad vote | bad, voted)."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def log_odds(self, votes: list[Column]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for v, g, b in zip(votes, self.on_good, self.on_bad, strict=True):
            total = total + F.when(v == 1, math.log(g / (1 - b))).when(v == -1, math.log((1 - g) / b)).otherwise(0.0)
        return total


def fit_rules(counts: DataFrame, steps: int = STEPS) -> RuleModel:
    """EM over the vote patterns of all rows of ``signals``, as one expression
    over the pattern table.  With no rows, or for a rule that never votes, the
    starting values remain."""
    r = len(RULES)
    votes = F.array(*[_vote(x) for x in RULES])
    patterns = counts.groupBy(votes.alias("v")).agg(F.count("*").cast("double").alias("n"))
    table = patterns.agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("p"))

    def total(condition: str, weight: str) -> str:
        return f"aggregate(t, 0D, (a, x) -> a + IF({condition}, {weight}, 0D))"

    def share(num: str, den: str, old: str) -> str:
        return f"greatest({_LEAST}D, least({1 - _LEAST}D, coalesce(try_divide({num}, {den}), {old})))"

    odds = ("ln(m.prior / (1 - m.prior)) + aggregate(sequence(0, {last}), 0D, (a, j) -> a + CASE x.v[j] "
            "WHEN 1 THEN ln(m.good[j] / (1 - m.bad[j])) WHEN -1 THEN ln((1 - m.good[j]) / m.bad[j]) ELSE 0D END)")
    weighed = f"transform(p, x -> struct(x.v AS v, x.n AS n, x.n / (1 + exp(-({odds.format(last=r - 1)}))) AS q))"
    good = share(total("x.v[j] = 1", "x.q"), total("x.v[j] != 0", "x.q"), "m.good[j]")
    bad = share(total("x.v[j] = -1", "x.n - x.q"), total("x.v[j] != 0", "x.n - x.q"), "m.bad[j]")
    prior = share(total("true", "x.q"), total("true", "x.n"), "m.prior")
    step = (f"transform(array({weighed}), t -> struct({prior} AS prior, "
            f"transform(sequence(0, {r - 1}), j -> {good}) AS good, transform(sequence(0, {r - 1}), j -> {bad}) AS bad))[0]")
    start = f"struct({START[2]}D AS prior, array_repeat({START[0]}D, {r}) AS good, array_repeat({START[1]}D, {r}) AS bad)"
    m = table.select(F.expr(f"aggregate(sequence(1, {steps}), {start}, (m, i) -> {step})").alias("m")).first()["m"]
    return RuleModel(m["prior"], tuple(m["good"]), tuple(m["bad"]))


def judge(counts: DataFrame, model: RuleModel) -> DataFrame:
    """``signals`` rows with base_failed, posterior (probability of good) and kept."""
    odds = model.log_odds([_vote(r) for r in RULES])
    return (counts.withColumn("base_failed", base_failed())
            .withColumn("posterior", 1 / (1 + F.exp(-odds)))
            .withColumn("kept", ~F.col("base_failed") & (odds >= 0)))


def keep_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were.  The text
    is read once to fit and once to filter; nothing is shuffled but patterns."""
    model = fit_rules(signals(docs, text, keep=()))
    row = "_row"
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.col(f"`{text}`").alias("_text"))
    out = judge(signals(packed, "_text", keep=(row,)), model)
    # a generator, not a filter: Catalyst would push a filter below the counts and evaluate them anew
    return out.select(F.inline(F.when(F.col("kept"), F.array(F.col(row)))))


def oracle_sql() -> str:
    """DuckDB SQL for the digest of ``judge``: counts, patterns, EM steps, verdict."""
    def vote(r):
        bad, good = VOTES[r]
        return f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS {r}"

    cols = ", ".join(RULES)
    odds = " + ".join(["ln(prior / (1 - prior))"] + [
        f"CASE {r} WHEN 1 THEN ln(good_{r} / (1 - bad_{r})) WHEN -1 THEN ln((1 - good_{r}) / bad_{r}) ELSE 0 END"
        for r in RULES])

    def share(num, den, old):
        return f"greatest({_LEAST}, least({1 - _LEAST}, coalesce({num} / nullif({den}, 0), any_value({old}))))"

    steps = ["m0 AS (SELECT " + f"{START[2]}::DOUBLE AS prior, " + ", ".join(
        f"{START[0]}::DOUBLE AS good_{r}, {START[1]}::DOUBLE AS bad_{r}" for r in RULES) + ")"]
    for k in range(1, STEPS + 1):
        q = f"(SELECT *, 1 / (1 + exp(-({odds}))) AS q FROM patterns, m{k - 1})"
        parts = [share("sum(n * q)", "sum(n)", "prior") + " AS prior"]
        for r in RULES:
            parts.append(share(f"sum(n * q) FILTER ({r} = 1)", f"sum(n * q) FILTER ({r} != 0)", f"good_{r}") + f" AS good_{r}")
            parts.append(share(f"sum(n * (1 - q)) FILTER ({r} = -1)", f"sum(n * (1 - q)) FILTER ({r} != 0)", f"bad_{r}") + f" AS bad_{r}")
        steps.append(f"m{k} AS MATERIALIZED (SELECT {', '.join(parts)} FROM {q})")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
pos AS (SELECT rid, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w),
tri AS (SELECT rid, i, x, lead(x, 1) OVER (PARTITION BY rid ORDER BY i) AS y, lead(x, 2) OVER (PARTITION BY rid ORDER BY i) AS z FROM pos),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x, y, z) AS c FROM tri WHERE z IS NOT NULL) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM dup) GROUP BY rid),
s AS (SELECT w.rid, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
      (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
      length(regexp_replace(t, '\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper,
      length(regexp_replace(t, '[^\p{{Lu}}\p{{Nd}}!-/:-@\[-`{{-~]+', '', 'g'))::BIGINT AS n_all
      FROM w LEFT JOIN rep ON w.rid = rep.rid),
c AS (SELECT *, n_all - n_upper AS n_marks FROM s),
v AS (SELECT *, {", ".join(vote(r) for r in RULES)} FROM c),
patterns AS MATERIALIZED (SELECT {cols}, count(*)::DOUBLE AS n FROM v GROUP BY {cols}),
{", ".join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND ({odds}) >= 0 AS kept
FROM v, m{STEPS}"""


def op9_quality_rules(spark, sf_dir):
    counts = stored(signals(documents(spark, sf_dir, "doc_id", "text")))
    out = judge(counts, fit_rules(counts))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")
