"""Registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from cohortlens.llm import (centroids, chat_format, collocations, decontaminate, exact_dedup, line_dedup, maxent, minhash_dedup, mixing,
                            packing, sharding, token_output, toxicity)


def llm_queries() -> dict:
    return {
        "op1_token_output": token_output.op1_token_output,
        "op2_decontamination": decontaminate.op2_decontamination,
        "op3_lm_scoring": maxent.op3_lm_scoring,
        "op4_chat_format": chat_format.op4_chat_format,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_mixing": mixing.op6_mixing,
        "op7_exact_dedup": exact_dedup.op7_exact_dedup,
        "op8_minhash_dedup": minhash_dedup.op8_minhash_dedup,
        "op9_line_dedup": line_dedup.op9_line_dedup,
        "op10_sharding": sharding.op10_sharding,
        "op11_collocations": collocations.op11_collocations,
        "op12_packing": packing.op12_packing,
        "op13_centroid_clusters": centroids.op13_centroid_clusters,
    }


def llm_oracles() -> dict:
    return {
        "op4_chat_format": chat_format.OP4_SQL,
        "op7_exact_dedup": exact_dedup.OP7_SQL,
        "op9_line_dedup": line_dedup.OP9_SQL,
        "op11_collocations": collocations.op11_collocations,
        "op12_packing": packing.op12_packing,
        "op11_collocations": collocations.OP11_SQL,
        "op13_centroid_clusters": centroids.OP13_SQL,
    }
