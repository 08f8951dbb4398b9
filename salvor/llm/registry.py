"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from salvor.llm import op1_mixing, op2_embeddings, op3_chat, op4_warc, op5_exact_dedup, op6_lines, op7_sharding, op8_quality, op9_simhash, op10_packing

QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing.op1_source_mixing,
        op2_embeddings.op2_embedding_pq,
        op3_chat.op3_chat_rendering,
        op4_warc.op4_warc_salvage,
        op5_exact_dedup.op5_chunk_recipe_dedup,
        op6_lines.op6_line_site_spread,
        op7_sharding.op7_hilbert_sharding,
        op8_quality.op8_quality_additive,
        op9_simhash.op9_simhash_bit_sliced,
        op10_packing.op10_best_fit_packing,
    )
}
#: op8 and op10 have no SQL: the model is trained, and tokens need a vocabulary that SQL lacks. Tests
#: compare them with held-out labels, the tokenizer and packing one by one.
ORACLES = {
    "op1_source_mixing": op1_mixing.ORACLE,
    "op2_embedding_pq": op2_embeddings.ORACLE,
    "op3_chat_rendering": op3_chat.ORACLE,
    "op4_warc_salvage": op4_warc.ORACLE,
    "op5_chunk_recipe_dedup": op5_exact_dedup.ORACLE,
    "op6_line_site_spread": op6_lines.ORACLE,
    "op7_hilbert_sharding": op7_sharding.ORACLE,
    "op9_simhash_bit_sliced": op9_simhash.ORACLE,
}
