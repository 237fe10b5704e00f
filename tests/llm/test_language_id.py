import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import docs_frame, edge_rows, words
from trellis.llm import language_id as L


def corpus():
    r = np.random.default_rng(3)
    make = {"en": "the and of with house water thing other", "de": "und der nicht straße über haus wasser ding",
            "ru": "и в не на дом вода вещь другой"}
    out = []
    for i in range(120):
        lang = ["en", "de", "ru"][i % 3]
        out.append((i, " ".join(r.choice(make[lang].split(), 30)), lang))
    return out


def brute_viterbi(scores, penalty):
    k = len(scores[0])
    best = list(scores[0])
    back = []
    for row in scores[1:]:
        top = max(range(k), key=lambda j: best[j])
        step = [s if best[s] >= best[top] - penalty else top for s in range(k)]
        back.append(step)
        best = [max(best[s], best[top] - penalty) + row[s] for s in range(k)]
    state = max(range(k), key=lambda j: best[j])
    path = [state]
    for step in reversed(back):
        state = step[state]
        path.append(state)
    return path[::-1]


def test_viterbi_against_one_sequence_at_a_time():
    r = np.random.default_rng(5)
    lengths = np.array([0, 7, 1, 30, 0, 13])
    scores = np.round(r.normal(size=(lengths.sum(), 3)) * 4).astype(np.float32)  # ties occur
    got = L.viterbi(scores, lengths, 5.0)
    at = 0
    for n in lengths:
        if n:
            assert got[at:at + n].tolist() == brute_viterbi(scores[at:at + n].astype(float).tolist(), 5.0)
        at += n


def test_held_out_accuracy_and_spans(spark):
    df = docs_frame(spark, corpus())
    model = L.fit_documents(df)
    assert model.languages == ["de", "en", "ru"]
    out = {r.doc_id: r for r in L.predict(df, model).collect()}
    assert all(out[i].lang_pred == lang for i, _, lang in corpus())
    assert all(0 <= r.score <= 1 for r in out.values())
    mixed = "the and of with house water " * 3 + "и в не на дом вода " * 3
    assert [x[2] for x in L.spans(model, mixed)] == ["en", "ru"]
    assert L.spans(model, mixed)[0][:2] == (0, 18)


def test_edges(spark):
    model = L.fit_documents(docs_frame(spark, corpus()))
    df = docs_frame(spark, edge_rows() + [(50, "1234 !!"), (51, "γειά σου κόσμε")])
    rows = L.predict(df, model).collect()
    assert len(rows) == df.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (2, 3, 4, 50))
    assert by[51].lang_pred in model.languages
    kept = L.keep_documents(df, model)
    assert kept.schema == df.schema
    assert {2, 3, 4, 50}.isdisjoint({r.doc_id for r in kept.select("doc_id").collect()})
    assert kept.where("doc_id = 8").count() == 2


def test_nothing_learned_and_empty_table(spark):
    empty = docs_frame(spark, [])
    model = L.fit_documents(empty)
    assert model.languages == []
    assert {r.lang_pred for r in L.predict(docs_frame(spark, edge_rows()), model).collect()} == {"und"}
    assert L.predict(empty, model).count() == 0
    assert L.spans(model, "a b") == []


def test_sampled_fit(spark):
    model = L.fit(docs_frame(spark, corpus()), max_rows=60)
    assert model.languages == ["de", "en", "ru"]


def test_nothing_learned_keeps_texts_with_a_letter(spark):
    model = L.fit_documents(docs_frame(spark, []))
    kept = L.keep_documents(docs_frame(spark, edge_rows() + [(50, "1234 !!"), (51, "γειά σου")]), model)
    assert sorted(r.doc_id or -1 for r in kept.select("doc_id").collect()) == [-1, 1, 5, 6, 7, 8, 8, 9, 10, 51]


def test_stage_decides_by_the_share_of_the_spans(spark):
    own = {"en": "the and of with house water", "de": "und der nicht straße über haus", "ru": "и в не на дом вода",
           "el": "και το δεν στο σπίτι νερό", "he": "של את לא על בית מים"}
    rows = [(100 * k + i, f"{text} " * 5, lang) for k, (lang, text) in enumerate(own.items()) for i in range(20)]
    model = L.fit_documents(docs_frame(spark, rows))
    assert model.languages == sorted(own)
    parts = [f"{text} " * 6 for text in own.values()]
    letters = max(len(p) for p in parts)
    salad = "".join(p * round(letters / len(p)) for p in parts)
    n = {p: len(p.replace(" ", "")) for p in parts}
    half = parts[0] * 3 + parts[2] * round(3 * n[parts[0]] / n[parts[2]])
    cases = docs_frame(spark, [(1, parts[0]), (2, parts[0] * 2 + parts[2]), (3, parts[1] * 6 + parts[3] + parts[0]), (4, salad), (5, half),
                               *[(10 + k, p) for k, p in enumerate(parts)]])
    assert sorted(r.doc_id for r in L.keep_documents(cases, model).collect()) == [1, 2, 3, 10, 11, 12, 13, 14]


def test_every_language_of_many_is_learned(spark):
    own = {f"l{k:03d}": words(1000 + k, 8) for k in range(90)}
    rows = [(100 * k + i, " ".join(w * 4), lang) for k, (lang, w) in enumerate(own.items()) for i in range(3 + (k < 70))]
    model = L.fit(docs_frame(spark, rows))
    assert model.languages == sorted(own)
    out = {r.doc_id: r.lang_pred for r in L.predict(docs_frame(spark, rows), model).collect()}
    assert all(out[i] == lang for i, _, lang in rows)


def test_word_scores_against_one_language_at_a_time(spark):
    model = L.fit(docs_frame(spark, corpus()))
    counts = {lang: np.zeros(L.BUCKETS) for lang in model.languages}
    for _, text, lang in corpus():
        counts[lang] += np.bincount(L.gram_buckets(text.split())[0], minlength=L.BUCKETS)
    letters, got = model.word_scores(["the", "straße", "вода", "wasser", "12", "σου"])
    assert letters.tolist() == [3, 6, 4, 6, 0, 3]
    for word, row in zip(["the", "straße", "вода", "wasser"], got, strict=False):
        mine = L.gram_buckets([word])[0]
        own = [np.log((counts[x][mine] + 0.5) / (counts[x].sum() + 0.5 * L.BUCKETS)).sum()
               if (x == "ru") == (word == "вода") else -np.inf for x in model.languages]
        assert np.allclose(row, np.maximum(np.array(own) - max(own), -L.WORD_RANGE), atol=1e-4)
    assert not got[4:].any()


def test_sample_counts_copies_once_and_has_every_language(spark):
    rows = [(i, f"text number {i} of these", "en") for i in range(3000)]
    rows += [(3000 + 1500 * k + i, f"the same text {k}", "de") for k in range(3) for i in range(1500)]
    rows += [(9000 + i, f"rare text {i}", "sw") for i in range(3)]
    languages, sample = L.training_rows(docs_frame(spark, rows).select("text", "lang"), 300)
    own = {r.lang: (r["n"], r.texts) for r in sample.groupBy("lang").agg(
        F.count("*").alias("n"), F.count_distinct("text").alias("texts")).collect()}
    assert languages == ["de", "en", "sw"]
    assert own["de"] == (3, 3) and own["sw"] == (3, 3) and 200 < own["en"][0] == own["en"][1] < 400
    assert L.fit(docs_frame(spark, rows), max_rows=300).languages == languages


def test_numerals_are_no_letters(spark):
    """A letter is of a Unicode letter category: fractions and Roman or circled numerals are not."""
    rows = [(i, " ".join(["the of and to in"] * 4), "en") for i in range(30)] + [(100 + i, " ".join(["der die und das ist"] * 4), "de") for i in range(30)]
    model = L.fit(docs_frame(spark, rows))
    odd = [(1, "\u00bd \u00b2 \u2460", None), (2, "\u2167", None), (3, "\u2460 the \u2167", None), (4, "12 _ --", None)]
    out = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs_frame(spark, odd), model).collect()}
    assert out[1] == out[2] == out[4] == ("und", 0.0) and out[3][0] == "en"
    kept = {r.doc_id for r in L.keep_documents(docs_frame(spark, odd), model).collect()}
    assert kept == {3}
