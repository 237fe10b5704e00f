import random
import re

import pytest

from tests.llm.cases import docs_frame, edge_rows, words
from trellis.llm import forest_join as J


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """(doc_id, n_links, group) by comparing all rows."""
    sets = [shingle_set(t) for _, t in rows]
    link = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j]
             and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(rows))]
    out = []
    for i, (doc, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc or -1, len(link[i]), min(ids, default=None)))
    return sorted(out, key=str)


def near_rows():
    r = random.Random(4)
    out = []
    for g in range(12):
        base = words(g, 150)
        for k in range(6):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 5, 9])):
                w[r.randrange(len(w))] = "changed%d" % r.randrange(10 ** 6)
            out.append((1000 + 10 * g + k, " ".join(w)))
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_links_and_groups_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK_SETS", block)
    rows = edge_rows() + near_rows()
    out = J.near_duplicates(docs_frame(spark, rows)).collect()
    got = sorted(((r.doc_id or -1, r.n_links, r.group_id) for r in out), key=str)
    assert got == brute(rows)


def test_rows_without_an_id_link_too(spark):
    base = words(77, 200)
    other = base[:100] + ["x"] + base[101:]
    rows = [(None, " ".join(base)), (None, " ".join(base)), (None, " ".join(other)), (4, " ".join(words(78, 50)))]
    out = J.near_duplicates(docs_frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_links) for r in out) == [(-1, 2), (-1, 2), (-1, 2), (4, 0)]
    rows.append((9, " ".join(other[:-1] + ["y"])))
    out = J.near_duplicates(docs_frame(spark, rows)).collect()
    assert {r.group_id for r in out} == {9, 4}


def test_keeps_one_of_each_group(spark):
    rows = edge_rows() + near_rows()
    df = docs_frame(spark, rows)
    kept = J.keep_documents(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id or -1) for r in kept.select("doc_id").collect())
    groups = {}
    for doc, n, group in brute(rows):
        groups.setdefault(group if n else ("own", doc), doc)
    want = [(r[0] if r[0] is not None else -1) for r in rows]
    stay = [min(d for d, n, g in brute(rows) if g == group and d >= 0) if not isinstance(group, tuple) else group[1]
            for group in groups]
    assert got == sorted(stay) and len(got) < len(want)


def test_least_depth_reaches_the_recall():
    assert J.recall_at(J.LEAST) >= J.RECALL > J.recall_at(J.LEAST + 1)


def test_prefixes_are_shortened_until_likely_partners_are_matched():
    full = [50] * (J.DEPTH - J.LEAST + 1)
    assert J.stop_depth(full) == J.DEPTH
    assert J.stop_depth([50, 50, 50, 49]) == 7 and J.stop_depth([1000, 1000, 995, 990]) == 7
    assert J.stop_depth([3, 2, 1, 1]) == J.LEAST and J.stop_depth([0, 0, 0, 0]) == J.LEAST


def test_matches_of_paths():
    r = random.Random(1)
    sets = [J.mix64(J.np.array(sorted(r.sample(range(300), 250)), J.np.uint64)) for _ in range(40)]
    paths = J.np.stack([J.labels(x) for x in sets])
    i, j = J.np.triu_indices(40, 1)
    longest, equal = J.match(paths, i, j)
    here = J.np.stack([J.met_here(J.starts_of(paths), J.np.full(40, t), i, j) for t in range(J.TREES)])
    for k, (a, b) in enumerate(zip(i, j, strict=True)):
        shared = [next((d for d in range(J.DEPTH) if paths[a, t, d] != paths[b, t, d]), J.DEPTH) for t in range(J.TREES)]
        assert longest[k] == max(shared) and equal[k] == (paths[a] == paths[b]).sum()
        first = next((t for t, d in enumerate(shared) if d >= J.LEAST), -1)
        assert J.np.flatnonzero(here[:, k]).tolist() == ([first] if first >= 0 else [])


def test_groups_across_batches_stay_whole():
    names = J._PLACE
    rows = [(g, 0, 0, 0, 0, i) for g in range(7) for i in range(g % 4)]
    table = J.pa.table({c: J.pa.array([r[k] for r in rows]) for k, c in enumerate([*names, "row"])})
    for size in (1, 2, 5, 100):
        got = [t.column("group").to_pylist() for t in J.whole_groups(table.to_batches(max_chunksize=size), names)]
        assert sum(got, []) == [r[0] for r in rows]
        ends = [(t[0], t[-1]) for t in got]
        assert all(x[1] != y[0] for x, y in zip(ends, ends[1:], strict=False))


def test_a_chain_of_texts_is_not_compared_all_with_all(spark):
    """Each text shares most shingles with the next one only: blocks and tried pairs grow
    with the chain, not with its square."""
    w = words(31, 2000)
    counts = []
    for n in (100, 200):
        rows = [(i + 1, " ".join(w[8 * i:8 * i + 160])) for i in range(n)]
        signed = J.map_arrow(docs_frame(spark, rows).select("doc_id", "text"), J._signatures, "doc_id long, key binary, n long, paths binary")
        classes = signed.withColumn("class_id", J.F.col("doc_id")).persist()
        groups = J.subtries(classes).persist()
        counts.append((groups.groupBy("group").count().agg(J.F.max("count")).first()[0], J._dealt(groups).count()))
        out = J.near_duplicates(docs_frame(spark, rows)).collect()
        assert sorted(((r.doc_id, r.n_links, r.group_id) for r in out), key=str) == brute(rows)
    assert counts[1][0] <= counts[0][0] + 6 and counts[1][1] < 2.6 * counts[0][1]


def test_empty_table_and_no_links(spark):
    assert J.near_duplicates(docs_frame(spark, [])).count() == 0
    out = J.near_duplicates(docs_frame(spark, [(1, None), (2, ""), (3, "a b c d e f")])).collect()
    assert all(r.kept and r.n_links == 0 and r.group_id == r.doc_id for r in out)


def test_one_large_group_of_copies(spark):
    text = " ".join(words(5, 60))
    out = J.near_duplicates(docs_frame(spark, [(i, text) for i in range(300)])).collect()
    assert {(r.n_links, r.group_id) for r in out} == {(299, 0)} and sum(r.kept for r in out) == 1


def test_rows_are_judged_by_their_class_not_by_their_id(spark):
    a, b, c = (" ".join(words(70 + i, 80)) for i in range(3))
    near = a.split()
    near[40] = "changed"
    rows = [(7, a), (7, b), (9, a), (9, c), (5, c), (3, a), (3, " ".join(near)), (3, None), (3, "")]
    kept = J.keep_documents(docs_frame(spark, rows)).select("doc_id", "text").collect()
    assert len(kept) == 5
    got = {(r.doc_id, r.text) for r in kept}
    assert {(7, b), (5, c), (3, None), (3, "")} <= got
    assert len(got & {(3, a), (3, " ".join(near))}) == 1
    out = J.near_duplicates(docs_frame(spark, rows)).where("kept").collect()
    assert sorted((r.doc_id, r.n_links) for r in out) == [(3, 0), (3, 0), (3, 3), (5, 1), (7, 0)]


def test_rows_without_an_id_leave_one_of_a_group(spark):
    rows = [(None, t) for _, t in near_rows()] + [(None, "a b c"), (None, "a b c"), (None, None), (None, "")]
    kept = [r.text for r in J.keep_documents(docs_frame(spark, rows)).collect()]
    sets = [shingle_set(t) for _, t in rows]
    group = {}
    for i, x in enumerate(sets):
        group[i] = i
        for j in range(i):
            if x and 5 * len(x & sets[j]) >= 4 * len(x | sets[j]) and group[j] != group[i]:
                old, new = group[i], group[j]
                group = {k: new if g == old else g for k, g in group.items()}
    text_group = {rows[i][1]: g for i, g in group.items()}
    assert sorted(text_group[t] for t in kept) == sorted({text_group[t] for _, t in rows})
    # one row with an id stays before any without
    rows.append((4, near_rows()[0][1]))
    kept = J.keep_documents(docs_frame(spark, rows)).where("doc_id = 4 or text is null").collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 4]
