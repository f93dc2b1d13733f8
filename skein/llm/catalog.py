"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from skein.llm import (bpe, decontaminate, jaccard_join, order_minhash, periodic_runs, pii, quality, seed_extend,
                       spelling_trie, suffix_dedup, token_count, toxicity, url_filter)

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_order_minhash": order_minhash.op4_order_minhash,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_pii": pii.op6_pii,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_pu_quality": quality.op8_pu_quality,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_token_counts": token_count.op10_token_counts,
    "op11_spelling_trie": spelling_trie.op11_spelling_trie,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_seed_extend": seed_extend.op13_seed_extend,
}
ORACLE = {"op5_jaccard_join": jaccard_join.OP5_SQL, "op9_url_filter": url_filter.OP9_SQL,
          "op13_seed_extend": seed_extend.OP13_SQL}
