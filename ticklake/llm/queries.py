"""Registered queries of this package and the SQL that must give the same rows."""

from __future__ import annotations

from ticklake.llm import (
    best_fit_packing, decontamination, exact_dedup, histogram_packing, importance, line_dedup, mixing, near_dedup, pii, secrets, spelling_variants, toxicity, winnowing,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_packing": histogram_packing.op2_packing,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_token_matrices": best_fit_packing.op4_token_matrices,
    "op5_mixing": mixing.op5_mixing,
    "op6_minhash_near_dedup": near_dedup.op6_minhash_near_dedup,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_pii": pii.op8_pii,
    "op9_secrets": secrets.op9_secrets,
    "op10_winnowing": winnowing.op10_winnowing,
    "op11_decontamination": decontamination.op11_decontamination,
    "op12_importance": importance.op12_importance,
    "op13_spelling_variants": spelling_variants.op13_spelling_variants,
}

ORACLES = {
    "op3_line_dedup": line_dedup.OP3_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op11_decontamination": decontamination.OP11_SQL,
    "op12_importance": importance.OP12_SQL,
    "op13_spelling_variants": spelling_variants.OP13_SQL,
}
