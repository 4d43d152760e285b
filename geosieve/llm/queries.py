"""The registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from . import audit, interpolation, media, mixing, neardup, packing, pii, quality, secrets, syncmers, tokencount, toxicity, whitening

QUERIES = {
    "op1_source_mixing": mixing.op1_source_mixing,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_pii": pii.op3_pii,
    "op4_minhash_dedup": neardup.op4_minhash_dedup,
    "op5_token_counts": tokencount.op5_token_counts,
    "op6_media_columns": media.op6_media_columns,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_syncmer_fingerprints": syncmers.op8_syncmer_fingerprints,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_toxicity_mil": toxicity.op10_toxicity_mil,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_filter_audit": audit.op12_filter_audit,
    "op13_interpolated_lm": interpolation.op13_interpolated_lm,
}
ORACLE_SQL: dict[str, str] = {"op1_source_mixing": mixing.OP1_SQL, "op12_filter_audit": audit.OP12_SQL}
