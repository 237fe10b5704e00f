"""From raw documents to packed training sequences, in stages.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir), reads what
its predecessor kept, and returns a DataFrame that is written as Parquet and
read again as the next one's ``docs``.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from trellis.llm import forest_join, language_id, packing, quality_rules
from trellis.session import delete_dir, shared_dir


def rule_stage(spark, docs, sf_dir):
    """Drop the documents that the fitted quality rules reject."""
    return quality_rules.keep_documents(docs)


def language_stage(spark, docs, sf_dir):
    """Drop the documents without a letter, and those whose spans show no main
    language; without a learned language every text with a letter stays."""
    return language_id.keep_documents(docs, language_id.fit_documents(docs))


def duplicate_stage(spark, docs, sf_dir):
    """Leave one document of each group of near duplicates."""
    return forest_join.keep_documents(docs)


def packing_stage(spark, docs, sf_dir):
    """Pack what is left into sequences; one row per piece."""
    return packing.pack_documents(docs, packing.vocabulary_path())


STAGES = [
    ("quality_rules", rule_stage),
    ("language_id", language_stage),
    ("ngram_jaccard_join", duplicate_stage),
    ("best_fit_packing", packing_stage),
]

#: No SQL: the stages learn models, compare signatures and run a tokenizer;
#: tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_dir(spark, before)
        docs, before = spark.read.parquet(path), path
    out = STAGES[-1][1](spark, docs, sf_dir)
    delete_dir(spark, before)           # the pieces are stored; their documents are not read again
    return out
