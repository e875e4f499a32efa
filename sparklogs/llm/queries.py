"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from sparklogs.llm import bpe, chat_format, embedding_dedup, exact_dedup, jaccard_join, lexical_search, license_scan, line_dedup, packing, secret_scan, suffix_dedup, token_alignment, toxicity

QUERIES = {
    "op1_embedding_dedup": embedding_dedup.query,
    "op2_suffix_dedup": suffix_dedup.query,
    "op3_chat_format": chat_format.query,
    "op4_secret_scan": secret_scan.query,
    "op5_packing": packing.query,
    "op6_exact_dedup": exact_dedup.query,
    "op7_toxicity": toxicity.query,
    "op8_bpe": bpe.query,
    "op9_jaccard_join": jaccard_join.query,
    "op10_license_scan": license_scan.query,
    "op11_lexical_search": lexical_search.query,
    "op12_token_alignment": token_alignment.query,
    "op13_line_dedup": line_dedup.query,
    "secret_scan_counts": secret_scan.counts,
}
SQL = {
    "op1_embedding_dedup": embedding_dedup.SQL,
    "op3_chat_format": chat_format.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op9_jaccard_join": jaccard_join.SQL,
    "op11_lexical_search": lexical_search.SQL,
    "op13_line_dedup": line_dedup.SQL,
    "secret_scan_counts": secret_scan.COUNTS_SQL,
}
