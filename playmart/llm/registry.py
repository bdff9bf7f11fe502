"""The queries of this subpackage and the DuckDB statements that check them."""

from __future__ import annotations

from playmart.llm.bpe import op1_byte_bpe
from playmart.llm.conversations import op13_conversation_repair
from playmart.llm.language import op11_lm_scoring
from playmart.llm.licenses import OP8_SQL, op8_license_scans
from playmart.llm.lines import op9_line_dedup
from playmart.llm.manifest import OP12_SQL, op12_merkle_manifest
from playmart.llm.near import OP6_SQL, op6_ngram_jaccard_join
from playmart.llm.packing import op10_best_fit_packing
from playmart.llm.pii import op3_pii
from playmart.llm.quality import OP5_SQL, op5_quality_rules
from playmart.llm.topk import OP2_SQL, op2_exact_top_k
from playmart.llm.toxicity import op4_toxicity
from playmart.llm.urls import OP7_SQL, op7_url_filters

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_url_filters": op7_url_filters,
    "op8_license_scans": op8_license_scans,
    "op9_line_dedup": op9_line_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES = {
    "op2_exact_top_k": OP2_SQL,
    "op5_quality_rules": OP5_SQL,
    "op6_ngram_jaccard_join": OP6_SQL,
    "op7_url_filters": OP7_SQL,
    "op8_license_scans": OP8_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
