"""Registered queries of the document operators and their oracle SQL."""

from __future__ import annotations

import corpus_pipeline
from ordermart.llm import bpe, collocations, fingerprints, html_text, jaccard, licenses, lm, minhash, packing, pii, ranked_search, topk, toxicity

QUERIES = {
    "op6_patience_licenses": licenses.op6_patience_licenses,
    "pipeline": corpus_pipeline.run,
    "op1_gru_lm": lm.op1_gru_lm,
    "op2_consistent_parsing": fingerprints.op2_consistent_parsing,
    "op5_kneser_ney_toxicity": toxicity.op5_kneser_ney_toxicity,
    "op7_ngram_jaccard": jaccard.op7_ngram_jaccard,
    "op3_html_text": html_text.op3_html_text,
    "op9_uniform_threshold": topk.op9_uniform_threshold,
    "op8_pii_spans": pii.op8_pii_spans,
    "op4_curve_packing": packing.op4_curve_packing,
    "op10_byte_bpe": bpe.op10_byte_bpe,
    "op11_tensored_minhash": minhash.op11_tensored_minhash,
    "op12_toivonen_collocations": collocations.op12_toivonen_collocations,
    "op13_range_maximum_search": ranked_search.op13_range_maximum_search,
}

ORACLE_SQL = {
    "op9_uniform_threshold": topk.ORACLE,
    "op12_toivonen_collocations": collocations.ORACLE,
    "op13_range_maximum_search": ranked_search.ORACLE,
}
