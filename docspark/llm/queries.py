"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat, counts, langid, licenses, mixing, packing, periods, phrases, quality, simhash, suffixes, topk, trie

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_substring_dedup": phrases.op3_substring_dedup,
    "op4_simhash": simhash.op4_simhash,
    "op5_exact_top_k": topk.op5_exact_top_k,
    "op6_chat_formatting": chat.op6_chat_formatting,
    "op7_mixing": mixing.op7_mixing,
    "op8_suffix_dedup": suffixes.op8_suffix_dedup,
    "op9_best_fit_packing": packing.op9_best_fit_packing,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_prefix_trie": trie.op11_prefix_trie,
    "op12_periodic_runs": periods.op12_periodic_runs,
    "op13_token_counts": counts.op13_token_counts,
}
ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": licenses.op2_sql(),
    "op3_substring_dedup": phrases.OP3_SQL,
    "op5_exact_top_k": topk.OP5_SQL,
    "op6_chat_formatting": chat.OP6_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op8_suffix_dedup": suffixes.OP8_SQL,
    "op11_prefix_trie": trie.OP11_SQL,
    "op12_periodic_runs": periods.OP12_SQL,
}
