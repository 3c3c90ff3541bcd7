"""Registered queries of this package and, where SQL can express them, the SQL they must equal."""

from __future__ import annotations

import corpus_pipeline
from llm import (
    byte_bpe,
    embedding_dedup,
    language_id,
    line_quality,
    ngram_join,
    phrases,
    quality_rules,
    source_mixing,
    spelling_variants,
    substring_dedup,
    suffix_dedup,
    token_files,
    url_filters,
)

QUERIES = {
    "op1_ngram_jaccard": ngram_join.op1_ngram_jaccard,
    "op2_byte_bpe": byte_bpe.op2_byte_bpe,
    "op3_url_filters": url_filters.op3_url_filters,
    "op4_embedding_dedup": embedding_dedup.op4_embedding_dedup,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_token_files": token_files.op6_token_files,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_source_mixing": source_mixing.op8_source_mixing,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_language_id": language_id.op10_language_id,
    "op11_phrase_collocations": phrases.op11_phrase_collocations,
    "op12_line_quality": line_quality.op12_line_quality,
    "op13_spelling_variants": spelling_variants.op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op3_url_filters": url_filters.ORACLE,
    "op11_phrase_collocations": phrases.ORACLE,
    "op13_spelling_variants": spelling_variants.ORACLE,
}
