"""The queries of this subpackage, by name, and the SQL that checks them."""

from loomlake.llm import conversation_trie, decontamination, exact_dedup, html_text, language_id, license_scan, line_dedup, mixing, near_dedup, token_files, vector_dedup, warc, whitening

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_language_id": language_id.op2_language_id,
    "op3_warc": warc.op3_warc,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_token_files": token_files.op6_token_files,
    "op7_html_text": html_text.op7_html_text,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_license_scan": license_scan.op10_license_scan,
    "op11_near_vectors": vector_dedup.op11_near_vectors,
    "op12_whitening": whitening.op12_whitening,
    "op13_prefix_trie": conversation_trie.op13_prefix_trie,
    "license_base_places": license_scan.license_base_places,
}

ORACLE_SQL = {
    "op3_warc": warc.OP3_SQL,
    "op4_decontamination": decontamination.OP4_SQL,
    "op8_exact_dedup": exact_dedup.OP8_SQL,
    "op9_line_dedup": line_dedup.OP9_SQL,
    "op11_near_vectors": vector_dedup.OP11_SQL,
    "op13_prefix_trie": conversation_trie.OP13_SQL,
    "license_base_places": license_scan.BASE_SQL,
}
