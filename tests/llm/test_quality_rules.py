import re
from collections import Counter

import duckdb
import pytest

from tests.llm.cases import docs_frame, edge_rows, prose, words
from trellis.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    t = text or ""
    ws = WORD.findall(t)
    tri = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    n = Counter(tri)
    covered = {j for i, x in enumerate(tri) if n[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(covered))


def rows():
    junk = " | ".join(words(3, 90))
    loud = "!! ".join(w.upper() for w in words(4, 90))
    again = "\n".join(["same line of words here"] * 20)
    out = edge_rows() + [(20, junk), (21, loud), (22, again), (23, "a b c a b c x a b"), (24, "x\r\ny\r\nx\r\n")]
    return out + [(100 + i, prose(100 + i, 80 + i) + ".\n" + prose(300 + i, 30)) for i in range(40)]


def test_counts_against_plain_python(spark):
    data = rows()
    out = Q.signals(docs_frame(spark, data)).collect()
    assert len(out) == len(data)
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) for r in out)
    assert got == sorted((i or -1, *expected(t)) for i, t in [(r[0], r[1]) for r in data])


def test_verdict_against_sql(spark):
    df = docs_frame(spark, rows(), clashes=False)
    counts = Q.signals(df).checkpoint()
    out = Q.judge(counts, Q.fit_rules(counts)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").toPandas()
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    sql = con.execute(Q.oracle_sql()).df()
    key = list(out.columns)

    def plain(frame):
        return sorted((tuple(None if v != v or v is None else int(v) for v in r) for r in frame[key].itertuples(index=False)),
                      key=str)
    assert plain(out) == plain(sql)


def test_rejects_junk_and_keeps_prose(spark):
    df = docs_frame(spark, rows())
    kept = Q.keep_documents(df)
    assert kept.columns == df.columns and kept.schema == df.schema
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert not {20, 21, 22, 2, 3, 4, 7} & set(ids)
    assert set(range(100, 140)) <= set(ids) and ids.count(8) == 2 and None in ids


def test_empty_table(spark):
    df = docs_frame(spark, [])
    assert Q.fit_rules(Q.signals(df)).prior == pytest.approx(Q.START[2])
    assert Q.keep_documents(df).count() == 0


def test_no_python_in_plan(spark):
    df = docs_frame(spark, rows())
    plan = Q.keep_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
