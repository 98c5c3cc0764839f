"""The subpackage's registered queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from tijara.llm import (bpe_codec, context_mixing, decontaminate, exact_dedup, fingerprints, hard_negatives, jaccard_join,
                        license_scan, periodic_runs, quality_knn, secret_scan, substring_dedup, token_counts)

QUERIES = {
    "op1_quality_knn": quality_knn.op1_quality_knn,
    "op2_license_scan": license_scan.op2_license_scan,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_jaccard_join": jaccard_join.op6_jaccard_join,
    "op7_context_mixing": context_mixing.op7_context_mixing,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_bpe_codec": bpe_codec.op9_bpe_codec,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_fingerprints": fingerprints.op13_fingerprints,
}

ORACLES = {
    "op6_jaccard_join": jaccard_join.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_fingerprints": fingerprints.ORACLE,
}
