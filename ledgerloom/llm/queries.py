"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from ledgerloom.llm import curve_packing, doc_fingerprint, exact_dedup, language_id, line_dedup, merkle_manifest, near_dedup, packing, ranked_search, secret_scan, sentence_pieces, substring_dedup, url_filter
from ledgerloom.llm.common import Query

QUERIES: dict[str, Query] = {
    "op1_sentence_pieces": sentence_pieces.op1_sentence_pieces,
    "op2_language_id": language_id.op2_language_id,
    "op3_minhash_near_dedup": near_dedup.op3_minhash_near_dedup,
    "op4_doc_fingerprint": doc_fingerprint.op4_doc_fingerprint,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_secret_scan": secret_scan.op7_secret_scan,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_curve_packing": curve_packing.op11_curve_packing,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_merkle_manifest": merkle_manifest.op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op9_exact_dedup": exact_dedup.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op12_ranked_search": ranked_search.SQL,
    "op13_merkle_manifest": merkle_manifest.SQL,
}
