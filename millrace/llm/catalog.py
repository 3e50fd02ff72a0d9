"""The queries of this subpackage and the SQL that states their results, where SQL can."""

from . import bpe, exact_dedup, jaccard_join, lm_score, media, packed_ids, packing, quality, secret_scan, suffix_dedup

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_token_output": packed_ids.op2_token_output,
    "op3_bpe": bpe.op3_bpe,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_lm_score": lm_score.op5_lm_score,
    "op6_gif": media.op6_gif,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_best_fit": packing.op8_best_fit,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_quality": quality.op10_quality,
}
ORACLES = {
    "op1_secret_scan": secret_scan.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
}
