"""The text operators as registered queries, and the DuckDB SQL of those SQL can express."""

from __future__ import annotations

import corpus_pipeline
from faremill.llm import (bpe, language, line_crf, mixing, pii, sharding, simhash, suffix_dedup,
                          toxicity, turn_repair, url_rules, vector_search, word_runs)

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_toxicity": toxicity.query,
    "op2_sharding": sharding.query,
    "op3_bpe": bpe.query,
    "op4_topk_search": vector_search.query,
    "op5_simhash": simhash.query,
    "op6_quality_rules": line_crf.query,
    "op7_url_filters": url_rules.query,
    "op8_mixing": mixing.query,
    "op9_pii": pii.query,
    "op10_language_id": language.query,
    "op11_word_runs": word_runs.query,
    "op12_turn_repair": turn_repair.query,
    "op13_suffix_dedup": suffix_dedup.query,
}
ORACLE = {
    "op2_sharding": sharding.SQL,
    "op4_topk_search": vector_search.SQL,
    "op8_mixing": mixing.SQL,
    "op12_turn_repair": turn_repair.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
