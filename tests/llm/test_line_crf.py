import itertools

import numpy as np

from tests.llm.cases import docs_frame, edge_rows, prose, words
from trellis.llm import line_crf as C
from trellis.llm.common import column_bytes


def labelled():
    docs, labels = [], []
    for i in range(240):
        good = i % 3 != 0
        text = "\n".join(prose(1000 * i + k, 12).capitalize() + "." for k in range(2 + i % 5))
        if not good:
            text = "\n".join(" ".join(w.upper() + "!!" for w in words(1000 * i + k, 12)) for k in range(2 + i % 5))
        docs.append((i, text))
        labels.append((i, int(good)))
    return docs, labels


def test_marginals_against_enumeration():
    r = np.random.default_rng(0)
    counts = np.array([3, 0, 1, 5])
    emission, pair = r.normal(size=9), r.normal(size=(2, 2))
    good, expected = C.forward_backward(emission, counts, pair)
    want, pairs, at = [], np.zeros((2, 2)), 0
    for n in counts:
        e = emission[at:at + n]
        at += n
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.array([np.exp(sum(e[i] * y for i, y in enumerate(p)) + sum(pair[a, b] for a, b in itertools.pairwise(p)))
                           for p in paths])
        weight /= weight.sum()
        want += [sum(w for w, p in zip(weight, paths, strict=True) if p[i]) for i in range(n)]
        for w, p in zip(weight, paths, strict=True):
            for a, b in itertools.pairwise(p):
                pairs[a, b] += w
    assert np.allclose(good, want) and np.allclose(expected, pairs)


def test_held_out_documents_are_told_apart(spark):
    docs, labels = labelled()
    df = docs_frame(spark, docs)
    known = spark.createDataFrame([*labels, (None, 1), (5000, 1), (1, None)], "doc_id long, quality int")
    model = C.fit_documents(df, known.where(~C.held_out()))
    score = {r.doc_id: r.score for r in C.score_documents(df, model).collect()}
    assert all((score[i] >= 0.5) == bool(y) for i, y in labels)


def test_edges(spark):
    docs, labels = labelled()
    model = C.fit_documents(docs_frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int"))
    df = docs_frame(spark, edge_rows())
    rows = C.score_documents(df, model).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[2] == by[3] == by[4] == model.prior
    assert by[1] == by[6]


def test_nothing_learned_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = C.fit_documents(docs_frame(spark, edge_rows()), none)
    assert {r.score for r in C.score_documents(docs_frame(spark, edge_rows()), model).collect()} == {0.5}
    assert C.score_documents(docs_frame(spark, []), model).count() == 0


def test_lines_of_a_text_do_not_depend_on_its_neighbours():
    import pyarrow as pa
    texts = ["A b c.\n\nA b c.\nX!! Y!!", "", "A b c.", "\n \n", "last 1 2 3"]
    whole = C.line_features(*column_bytes(pa.array(texts)))
    parts = [C.line_features(*column_bytes(pa.array([t]))) for t in texts]
    assert np.array_equal(whole.features, np.concatenate([p.features for p in parts]))
    assert whole.counts.tolist() == [int(p.counts[0]) for p in parts] == [3, 0, 1, 0, 1]
