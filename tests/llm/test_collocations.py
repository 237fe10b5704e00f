import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import docs_frame, edge_rows
from trellis.llm import collocations as C


def brute(rows, least, longest, top=2000, covered=50):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, *rest in rows:
        lang = (rest[0] if rest else None) or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        held = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        found = []
        for p, a in held.items():
            if any(100 * n >= covered * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, n in held.items()):
                continue
            score, cut = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows(n=160):
    """Few words, so that phrases repeat; breaks, capitals and a common word."""
    r = random.Random(5)
    names = ["the", "Red", "fox", "ÉTÉ", "été", "a-b", "new", "york", "city", "#", "日本", "x"]
    out = []
    for i in range(n):
        text = ""
        for _ in range(r.randint(0, 60)):
            text += r.choice(["the", r.choice(names), "New York", "new york city"]) + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!\x0b"])
        out.append((i, text, r.choice(["en", "en", None, "und", "de"])))
    return out + [(x, t, "en") for x, t in edge_rows()] + [(500 + i, "copied text here again. " * 3, "de") for i in range(40)]


@pytest.mark.parametrize("share,longest", [(0.25, 3), (0.02, 3), (0.5, 4), (1.0, 2)])
def test_against_counting_everything(spark, share, longest):
    rows = phrase_rows()
    df = docs_frame(spark, rows).repartition(5)
    out = C.collocations(df, share=share, longest=longest, least=4, top=150)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, 4, longest, top=150)


def test_expansion_passes_happen_and_close(spark, monkeypatch):
    """With a sample that proposes nothing, later passes find every phrase."""
    rows = phrase_rows(80)
    passes = []
    real = C._pass
    monkeypatch.setattr(C, "_pass", lambda *a, **k: passes.append(a[1]) or real(*a, **k))
    out = C.frequent_phrases(docs_frame(spark, rows), least=4, share=0.0)
    got = {(r.lang, r.phrase): r.n for r in out.where("k > 0").collect()}
    assert len(passes) > 3                               # two of the sample, then full passes until closed
    f = defaultdict(int)
    for _, text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang or "und", " ".join(w[i:i + k])] += 1
    assert got == {k: n for k, n in f.items() if n >= 4}


def test_query_against_sql(spark, tmp_path):
    """The registered query, with its own parameters, over a folder."""
    df = docs_frame(spark, phrase_rows(), clashes=False)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    out = sorted(tuple(r) for r in C.op13_collocations(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert out == sorted(con.execute(C.oracle_sql()).fetchall()) and out


def test_windows_of_a_long_text(monkeypatch):
    """Windows of any size count each phrase once, as the whole text does."""
    text = phrase_rows(1)[0][1] * 3 + "w" * 90 + " tail without any break " * 4
    batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array(["en"])], ["text", "lang"])

    def grams(longest=3):
        found = Counter()
        for s in C._slices([batch], longest):
            names = s.names.to_pylist()
            for k in range(1, longest + 1):
                for i in range(len(s.unit) - k + 1):
                    if s.piece[i] == s.piece[i + k - 1] and s.new[i + k - 1]:
                        found[tuple(names[u] for u in s.unit[i:i + k])] += 1
        return found

    whole = grams()
    for size in (1, 7, 20, 64, 200):
        monkeypatch.setattr(C, "WINDOW_BYTES", size)
        assert grams() == whole


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(9_000_000_000, 10_000_000_000, 9_500_000_000)], "a long, l long, r long")
    a, left, right = 9_000_000_000, 10_000_000_000, 9_500_000_000
    assert df.select(C._score("a", "l", "r").alias("s")).first().s == 1000000 * a * a // (left * right)


def test_empty_table_and_nothing_frequent(spark):
    assert C.collocations(docs_frame(spark, [])).count() == 0
    assert C.collocations(docs_frame(spark, [(1, "each word differs", "en"), (2, None, None)])).count() == 0


def test_maps_hold_every_proposed_phrase(spark):
    r = np.random.default_rng(2)
    hashes = r.integers(0, 2 ** 64, 500, dtype=np.uint64)
    hashes[:2] = [0, 2 ** 64 - 1]
    codes = np.concatenate([C.codes_of(hashes[:200], 1), C.codes_of(hashes[200:], 3)]).view(np.int64)
    now, failed = C.Proposals().with_codes(spark.createDataFrame([(int(c),) for c in codes], "code long"))
    assert failed and now.has(1, hashes[:200]).all() and now.has(3, hashes[200:]).all()
    assert not now.has(2, hashes).any() and now.has(1, hashes[200:]).mean() < 0.01
    same, failed = now.with_codes(spark.createDataFrame([], "code long"))
    assert not failed and all((same.maps[k] == now.maps[k]).all() for k in now.maps)


def test_equal_hashes_of_different_texts_stay_apart():
    tally = C._Tally()
    one = np.array([5, 5, 9], np.uint64)
    for texts in (["a", "b", "c"], ["b", "a", "c"], ["b", "b2", "c"]):
        tally.add(pa.array(texts, pa.large_string()), np.array([1, 10, 100]), one)
    out = Counter()
    for batch in tally.spend():
        for name, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            out[name] += n
    assert out == {"a": 11, "b": 12, "b2": 10, "c": 300} and not list(tally.spend())
