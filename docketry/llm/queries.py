"""The registered queries of this folder."""

from __future__ import annotations

from . import decontaminate, divergence, embedding_dedup, html_text, jaccard_join, mixing, pii, resampling, substring_dedup, token_codec, token_counts, toxicity, url_filter


def queries():
    return {
        "op1_ngram_jaccard_join": jaccard_join.op1_ngram_jaccard_join,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_embedding_near_dedup": embedding_dedup.op3_embedding_near_dedup,
        "op4_pii": pii.op4_pii,
        "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
        "op6_token_counts": token_counts.op6_token_counts,
        "op7_url_filter": url_filter.op7_url_filter,
        "op8_token_ids": token_codec.op8_token_ids,
        "op9_substring_dedup": substring_dedup.op9_substring_dedup,
        "op10_mixing": mixing.op10_mixing,
        "op11_resampling": resampling.op11_resampling,
        "op12_source_divergence": divergence.op12_source_divergence,
        "op13_html_text": html_text.op13_html_text,
    }


def oracle_sql():
    return {
        "op5_benchmark_decontamination": decontaminate.ORACLE_SQL,
        "op7_url_filter": url_filter.ORACLE_SQL,
        "op10_mixing": mixing.ORACLE_SQL,
        "op11_resampling": resampling.ORACLE_SQL,
        "op12_source_divergence": divergence.ORACLE_SQL,
    }
