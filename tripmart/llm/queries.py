"""Registered queries of the text operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from tripmart.llm import bpe, chat, langid, ledger, lm, merkle, repeats, resample, simhash, tokencount, toxicity, urls, winnow

QUERIES = {
    "op1_lm_scoring": lm.op1_lm_scoring,
    "op2_bpe": bpe.op2_bpe,
    "op3_token_counts": tokencount.op3_token_counts,
    "op4_quality_rules": ledger.op4_quality_rules,
    "op5_decontamination": winnow.op5_decontamination,
    "op6_simhash": simhash.op6_simhash,
    "op7_language_id": langid.op7_language_id,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_chat_formatting": chat.op9_chat_formatting,
    "op10_url_filters": urls.op10_url_filters,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_importance_resampling": resample.op12_importance_resampling,
    "op13_suffix_dedup": repeats.op13_suffix_dedup,
}

ORACLE_SQL = {
    "op4_quality_rules": ledger.OP4_SQL,
    "op5_decontamination": winnow.OP5_SQL,
    "op9_chat_formatting": chat.OP9_SQL,
    "op10_url_filters": urls.OP10_SQL,
    "op11_merkle_manifest": merkle.OP11_SQL,
}
