"""Registered corpus queries and their DuckDB equivalents."""

from __future__ import annotations

import corpus_pipeline
from meterlake.llm.chat import OP6_SQL, op6_chat_format
from meterlake.llm.filter_audit import OP13_SQL, op13_filter_audit
from meterlake.llm.jaccard import OP12_SQL, op12_jaccard_join
from meterlake.llm.minhash import op7_minhash_fingerprints
from meterlake.llm.mixing import op3_mix_sources
from meterlake.llm.packing import op4_best_fit_packing
from meterlake.llm.quality import op2_quality_rules
from meterlake.llm.repeats import op8_substring_dedup
from meterlake.llm.simhash import op9_simhash_near_dedup
from meterlake.llm.spelling import op11_spelling_variants
from meterlake.llm.token_counts import op5_token_counts
from meterlake.llm.token_store import op10_token_store
from meterlake.llm.url_rules import op1_url_rules

QUERIES = {f.__name__: f for f in (
    op1_url_rules, op2_quality_rules, op3_mix_sources, op4_best_fit_packing, op5_token_counts,
    op6_chat_format, op7_minhash_fingerprints, op8_substring_dedup, op9_simhash_near_dedup,
    op10_token_store, op11_spelling_variants, op12_jaccard_join, op13_filter_audit)}
QUERIES["pipeline"] = corpus_pipeline.run
# The others cannot be said in SQL (learned rules, seeded hashes, tokenizers, packing); tests/llm has brute-force
# versions of them.
ORACLES = {"op6_chat_format": OP6_SQL.strip(), "op12_jaccard_join": OP12_SQL.strip(), "op13_filter_audit": OP13_SQL.strip()}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
