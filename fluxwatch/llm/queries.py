"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from fluxwatch.llm import (
    binary, decontamination, embeddings, lines, mixing, packing, periodic, quality, resampling, sharding, simhash, tokens, toxicity,
)

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_token_counts": tokens.op2_token_counts,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_packing": packing.op4_packing,
    "op5_token_files": binary.op5_token_files,
    "op6_simhash": simhash.op6_simhash,
    "op7_line_dedup": lines.op7_line_dedup,
    "op8_quality": quality.op8_quality,
    "op9_mixing": mixing.op9_mixing,
    "op10_embeddings": embeddings.op10_embeddings,
    "op11_periodic": periodic.op11_periodic,
    "op12_decontamination": decontamination.op12_decontamination,
    "op13_resampling": resampling.op13_resampling,
}

ORACLES = {"op7_line_dedup": lines.OP7_SQL, "op9_mixing": mixing.OP9_SQL, "op12_decontamination": decontamination.OP12_SQL}
