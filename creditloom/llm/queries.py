"""The registered queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from creditloom.llm import ann, byte_bpe, exact_topk, language_id, lexical, line_dedup, lm_score, mixing, near_dup, pieces, pii, runs, toxicity

LLM_QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_minhash_dedup": near_dup.op2_minhash_dedup,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_pii": pii.op5_pii,
    "op6_lm_score": lm_score.op6_lm_score,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_exact_topk": exact_topk.op8_exact_topk,
    "op9_language_id": language_id.op9_language_id,
    "op10_nearest": ann.op10_nearest,
    "op11_byte_bpe": byte_bpe.op11_byte_bpe,
    "op12_ranked_search": lexical.op12_ranked_search,
    "op13_periodic_runs": runs.op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}
LLM_ORACLES = {
    "op2_minhash_dedup": near_dup.OP2_SQL,
    "op5_pii": pii.OP5_SQL,
    "op8_exact_topk": exact_topk.OP8_SQL,
    "op12_ranked_search": lexical.OP12_SQL,
}
