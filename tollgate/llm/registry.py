"""Registered queries of the operators: name -> (function, DuckDB SQL or None)."""

from __future__ import annotations

from tollgate.llm import chat_format, embedding_graph, langid, line_dedup, minhash, phrases, pii, runs, sentencepiece_sample, sharding, tiling, token_counts, toxicity

REGISTRY = {
    "op1_chat_format": (chat_format.op1_chat_format, chat_format.SQL),
    "op2_minhash": (minhash.op2_minhash, minhash.SQL),
    "op5_tiling": (tiling.op5_tiling, None),
    "op6_embedding_graph": (embedding_graph.op6_embedding_graph, None),
    "op7_line_dedup": (line_dedup.op7_line_dedup, line_dedup.SQL),
    "op8_sentencepiece": (sentencepiece_sample.op8_sentencepiece, None),
    "op9_toxicity": (toxicity.op9_toxicity, None),
    "op10_langid": (langid.op10_langid, None),
    "op3_pii": (pii.op3_pii, None),
    "op4_token_counts": (token_counts.op4_token_counts, None),
    "op11_phrases": (phrases.op11_phrases, phrases.SQL),
    "op12_sharding": (sharding.op12_sharding, sharding.SQL),
    "op13_runs": (runs.op13_runs, None),
}
