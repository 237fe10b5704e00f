"""Registered queries of the corpus operators: (spark, sf_dir) -> DataFrame.

Each applies its operator, with production parameters, to its whole table and
derives the digest columns from the operator's output.
"""

from __future__ import annotations

from trellis.llm import code_search, collocations, quality_rules
from trellis.llm.byte_bpe import op7_byte_bpe
from trellis.llm.code_search import op11_equal_average
from trellis.llm.collocations import op13_collocations
from trellis.llm.forest_join import op3_ngram_jaccard_join
from trellis.llm.gru_lm import op12_gru_scores
from trellis.llm.language_id import op8_language_id
from trellis.llm.line_crf import op5_line_crf
from trellis.llm.multi_index import op2_multi_index
from trellis.llm.packing import op4_best_fit_packing
from trellis.llm.quality_rules import op9_quality_rules
from trellis.llm.sharding import op6_rendezvous_sharding
from trellis.llm.token_counts import op10_token_counts
from trellis.llm.warc import op1_warc


def all_queries() -> dict:
    found = (op1_warc, op2_multi_index, op3_ngram_jaccard_join, op4_best_fit_packing, op5_line_crf,
             op6_rendezvous_sharding, op7_byte_bpe, op8_language_id, op9_quality_rules, op10_token_counts, op11_equal_average, op12_gru_scores,
             op13_collocations)
    return {f.__name__: f for f in found}


def all_sql() -> dict:
    """DuckDB SQL where a query's rows have an SQL form."""
    return {"op9_quality_rules": quality_rules.oracle_sql(), "op11_equal_average": code_search.oracle_sql(),
            "op13_collocations": collocations.oracle_sql()}
