"""The queries of this subpackage and the SQL that checks them, by name."""

from __future__ import annotations

from . import bytes_dedup, decontamination, fingerprints, jaccard_join, language_id, line_dedup, pieces, prefix_trie, ranked_search, substring_dedup, toxicity, vector_join, warc

QUERIES = {
    "op5_pieces": pieces.op5_pieces,
    "op10_language_id": language_id.op10_language_id,
    "op6_toxicity": toxicity.op6_toxicity,
    "op3_warc": warc.op3_warc,
    "op1_vector_join": vector_join.op1_vector_join,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_suffix_dedup": bytes_dedup.op8_suffix_dedup,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op11_fingerprints": fingerprints.op11_fingerprints,
}
SQL = {
    "op3_warc": warc.SQL,
    "op1_vector_join": vector_join.SQL,
    "op4_jaccard_join": jaccard_join.SQL,
    "op9_line_dedup": line_dedup.SQL,
    "op7_decontamination": decontamination.SQL,
    "op8_suffix_dedup": bytes_dedup.SQL,
    "op2_substring_dedup": substring_dedup.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
    "op12_ranked_search": ranked_search.SQL,
}
