"""Registered queries of this package, and their SQL where SQL can express
them."""

from __future__ import annotations

from closeledger.llm import curves, decontam, jaccard, langid, lblm, licenses, pieces, rulefit, sharding, trie, warc, whitening, windows

QUERIES = {
    "op1_hilbert_sharding": sharding.op1_hilbert_sharding,
    "op2_language_id": langid.op2_language_id,
    "op3_log_bilinear": lblm.op3_log_bilinear,
    "op4_decontamination": decontam.op4_decontamination,
    "op5_curve_neighbours": curves.op5_curve_neighbours,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_quality_rules": rulefit.op7_quality_rules,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_suffix_dedup": windows.op10_suffix_dedup,
    "op11_prefix_trie": trie.op11_prefix_trie,
    "op12_whitening": whitening.op12_whitening,
    "op13_warc": warc.op13_warc,
}

ORACLE = {
    "op6_license_scan": licenses.oracle_sql(),
    "op11_prefix_trie": trie.oracle_sql(),
    "op13_warc": warc.oracle_sql(),
}
