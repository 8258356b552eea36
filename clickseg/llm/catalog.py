"""Queries of this subpackage and their DuckDB texts, for ``__spark_entry__``."""

from __future__ import annotations

from clickseg.llm import (decontaminate, embeddings, lengths, linededup, linerules, minhash, mixing, negatives, quality,
                          substrings, toxicity, urls, whitening)


def all_queries() -> dict:
    return {
        "op1_minhash_dedup": minhash.op1_minhash_dedup,
        "op2_substring_dedup": substrings.op2_substring_dedup,
        "op3_url_filter": urls.op3_url_filter,
        "op4_embedding_dedup": embeddings.op4_embedding_dedup,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_quality": quality.op6_quality,
        "op7_mix_sources": mixing.op7_mix_sources,
        "op8_line_dedup": linededup.op8_line_dedup,
        "op9_token_lengths": lengths.op9_token_lengths,
        "op10_decontaminate": decontaminate.op10_decontaminate,
        "op11_hard_negatives": negatives.op11_hard_negatives,
        "op12_whiten": whitening.op12_whiten,
        "op13_line_rules": linerules.op13_line_rules,
    }


def all_sql() -> dict[str, str]:
    return {"op2_substring_dedup": substrings.OP2_SQL, "op4_embedding_dedup": embeddings.OP4_SQL,
            "op7_mix_sources": mixing.OP7_SQL, "op8_line_dedup": linededup.OP8_SQL,
            "op11_hard_negatives": negatives.OP11_SQL, "op13_line_rules": linerules.OP13_SQL}
