import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.cases import docs_frame, edge_rows, prose, words
from tests.llm.test_forest_join import shingle_set
from tests.llm.test_language_id import brute_viterbi
from tests.llm.test_packing import check_layout
from trellis.llm import language_id, packing, quality_rules, queries


def test_stages_run_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL).persist()
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert 0 < out.count() <= before
        docs, before = out, out.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == before


@pytest.mark.parametrize("rows", [[], edge_rows() + [(100 + i, prose(i, 90), "en") for i in range(30)]])
def test_edges_pass_through_all_stages(spark, rows):
    docs = docs_frame(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, None)
        assert docs.columns == docs_frame(spark, []).columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, None).count() >= (30 if rows else 0)


def test_registered_names():
    names = list(queries.all_queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.all_sql()) <= set(names)


@pytest.mark.parametrize("null", ["lang", "doc_id"])
def test_run_keeps_clean_documents_where_no_language_is_learned(spark, tmp_path, null):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.withColumn(null, F.lit(None).cast(docs.schema[null].dataType)).write.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.rule_stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), None)
    kept = corpus_pipeline.duplicate_stage(spark, kept, None).count()       # every document has a letter
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert kept and sum(r.piece == 0 for r in out) == kept


def plain_rules(docs):
    """Ids that the rules' SQL keeps."""
    con = duckdb.connect()
    con.register("documents", docs)
    return {i for i, kept in con.execute(f"SELECT doc_id, kept FROM ({quality_rules.oracle_sql()})").fetchall() if kept}


def plain_main_language(model, text):
    """Whether one language's spans hold enough letters, a word and a text at a time."""
    own = text.split()
    letters, scores = model.word_scores(own)
    path = brute_viterbi(scores.astype(float).tolist(), language_id.SWITCH_PENALTY) if own else []
    held = Counter()
    for n, k in zip(letters.tolist(), path, strict=True):
        held[k] += n
    return sum(held.values()) > 0 and max(held.values()) >= language_id.KEEP_SHARE * sum(held.values())


def plain_groups(rows):
    """Ids that stay: of each group of near duplicates the smallest; all pairs compared."""
    sets = {i: shingle_set(t) for i, t in rows}
    group = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and group[a] != group[b] and 5 * len(x & y) >= 4 * len(x | y):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    return {i for i in ids if group[i] == i}


def test_run_against_plain_stages(spark, tmp_path):
    """The rows of run() against the four stages done one document at a time."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    base = words(5, 200)
    more = [(5000 + k, " ".join(base[:190 - k] + words(60 + k, 10)), "en") for k in range(6)]
    more += [(5100, prose(8, 100) + " " + docs.first().text[:400], "en"), (5101, "short", "en"), (5102, None, None), (5103, "1 2 3 " * 90, "de")]
    other = {r.lang: r.text for r in docs.where("length(text) > 1500").orderBy("doc_id").select("lang", "text").collect()}
    more.append((5200, " ".join(t[:1400] for _, t in sorted(other.items())), "en"))      # several languages in like parts
    docs = docs.unionByName(docs_frame(spark, more, clashes=False).select(*docs.columns))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert len(rows) == docs.count()
    ruled = plain_rules(docs.toPandas())
    kept = docs.where(F.col("doc_id").isin(sorted(ruled)))
    model = language_id.fit_documents(kept)
    spoken = {i for i in ruled if plain_main_language(model, rows[i] or "")}
    stay = plain_groups([(i, rows[i]) for i in spoken])
    assert 5200 in ruled - spoken and len(rows) > len(ruled) > len(spoken) > len(stay) > 100
    whole = packing.word_tokenizer(packing.vocabulary_path())
    want = []
    for i in stay:
        ids = np.array(whole.encode(rows[i], add_special_tokens=False).ids + [packing.END_ID], "<u4")
        want += [(i, p, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes())) for p, a in enumerate(range(0, len(ids), 4096))]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    assert check_layout(out, 4096) <= -(-sum(r.length for r in out) // 4096) + 1


def test_every_query_runs_on_a_folder_of_tables(spark, tmp_path):
    """Each opN_ query over a small folder gives a row for each row of its table."""
    tables = {"documents": "documents", "embeddings": "embeddings", "pages": "pages", "labels": "labels"}
    for name in tables:
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(60).write.parquet(str(tmp_path / f"{name}.parquet"))
    size = {name: spark.read.parquet(str(tmp_path / f"{name}.parquet")).count() for name in tables}
    for name, query in queries.all_queries().items():
        n = int(re.match(r"op(\d+)_", name)[1])
        rows = query(spark, str(tmp_path)).count()
        if n == 13:
            assert rows > 0
        else:
            table = "pages" if n == 1 else "embeddings" if n in (2, 11) else "documents"
            assert rows >= size[table] if n == 4 else rows == size[table], name
