"""The queries of this folder and their SQL: one opN_ query for each operator."""

from __future__ import annotations

from lensmill.llm import byte_bpe, curriculum, jaccard_join, line_dedup, media_columns, preference, quality_ledger, surrogates, url_cascade, warc_dict

_ALL = {
    "op1_preference_format": preference,
    "op2_pii_surrogates": surrogates,
    "op3_warc_dictionary": warc_dict,
    "op4_byte_bpe": byte_bpe,
    "op5_line_dedup": line_dedup,
    "op6_url_bloom_cascade": url_cascade,
    "op7_media_columns": media_columns,
    "op8_curriculum_mix": curriculum,
    "op9_rule_bitmask_ledger": quality_ledger,
    "op10_ngram_jaccard": jaccard_join,
}


def queries() -> dict:
    return {name: module.query for name, module in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.SQL for name, module in _ALL.items() if getattr(module, "SQL", None)}
