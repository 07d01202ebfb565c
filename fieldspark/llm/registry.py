"""The corpus queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from fieldspark.llm import bpe, decontaminate, fingerprints, html_text, language_id, licenses, line_dedup, lm_score, ngram_join, periodic_runs, spelling, substring_dedup, token_counts

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_bpe": bpe.op2_bpe,
    "op3_language_id": language_id.op3_language_id,
    "op5_html_text": html_text.op5_html_text,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op6_fingerprints": fingerprints.op6_fingerprints,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_lm_score": lm_score.op9_lm_score,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_substring_dedup": substring_dedup.op12_substring_dedup,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}
SQL = {
    "op8_license_scan": licenses.OP8_SQL,
    "op4_decontaminate": decontaminate.OP4_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op12_substring_dedup": substring_dedup.OP12_SQL,
}
