"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from annomart.llm.op1_packing import op1_best_fit_packing
from annomart.llm.op2_phrases import OP2_SQL, op2_repeated_phrases
from annomart.llm.op3_jaccard import OP3_SQL, op3_jaccard_join
from annomart.llm.op4_lm import op4_lm_scores
from annomart.llm.op5_suffixes import OP5_SQL, op5_suffix_dedup
from annomart.llm.op6_urls import OP6_SQL, op6_url_filters
from annomart.llm.op7_quality import op7_quality_rules
from annomart.llm.op8_tokens import op8_token_counts
from annomart.llm.op9_decontam import op9_decontamination
from annomart.llm.op10_licenses import op10_license_scan, op10_sql
from annomart.llm.op11_whitening import op11_whitening
from annomart.llm.op12_ranking import op12_quality_ranking
from annomart.llm.op13_align import op13_align_tokenizers

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_repeated_phrases": op2_repeated_phrases,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_lm_scores": op4_lm_scores,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_url_filters": op6_url_filters,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_counts": op8_token_counts,
    "op9_decontamination": op9_decontamination,
    "op10_license_scan": op10_license_scan,
    "op11_whitening": op11_whitening,
    "op12_quality_ranking": op12_quality_ranking,
    "op13_align_tokenizers": op13_align_tokenizers,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op2_repeated_phrases": OP2_SQL,
    "op3_jaccard_join": OP3_SQL,
    "op5_suffix_dedup": OP5_SQL,
    "op6_url_filters": OP6_SQL,
    "op10_license_scan": op10_sql(),
}
