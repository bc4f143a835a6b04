"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from . import ann, byte_bpe, exact_dedup, jaccard_join, language_id, lexical_search, license_scan, line_dedup, lm_scoring, mixing, packing, periodic_runs, secret_scan

QUERIES = {
    "op1_lm_score": lm_scoring.op1_lm_score,
    "op2_ann_dimension_scan": ann.op2_ann_dimension_scan,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_language_id": language_id.op5_language_id,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_source_mix": mixing.op7_source_mix,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_packed_ids": packing.op10_packed_ids,
    "op11_line_dedup": line_dedup.op11_line_dedup,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE_SQL = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op11_line_dedup": line_dedup.OP11_SQL,
    "op12_lexical_search": lexical_search.OP12_SQL,
}
