"""Driver queries of the training-data operators (N of ``opN_`` as dealt)."""

from __future__ import annotations

from . import classifier, decontam, fingerprint, langid, linededup, lm, neardup, packing, prefixtrie, quality_rules, secret_scan, urlfilter, whitening

QUERIES = {
    "op1_quality_classifier": classifier.op1,
    "op2_line_dedup": linededup.op2,
    "op3_lm_scoring": lm.op3,
    "op4_quality_rules": quality_rules.op4,
    "op5_benchmark_decontamination": decontam.op5,
    "op6_language_id": langid.op6,
    "op7_url_filters": urlfilter.op7,
    "op8_minhash_near_dedup": neardup.op8,
    "op9_secret_scan": secret_scan.op9,
    "op10_packing": packing.op10,
    "op11_embedding_whitening": whitening.op11,
    "op12_document_fingerprints": fingerprint.op12,
    "op13_conversation_trie": prefixtrie.op13,
}

ORACLE_SQL: dict[str, str] = {"op7_url_filters": urlfilter.ORACLE}
