"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tidewatch.llm import (
    centroids,
    chat,
    divergence,
    exact,
    minhash,
    packing,
    piece,
    quality,
    repeats,
    tokencounts,
    tokenfile,
    topk,
    toxicity,
)
from tidewatch.llm.common import Query

QUERIES: dict[str, Query] = {
    "op1_chat_snapshots": chat.op1_chat_snapshots,
    "op2_token_file": tokenfile.op2_token_file,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_quality": quality.op4_quality,
    "op5_exact_dedup": exact.op5_exact_dedup,
    "op6_topk": topk.op6_topk,
    "op7_repeats": repeats.op7_repeats,
    "op8_minhash": minhash.op8_minhash,
    "op9_packing": packing.op9_packing,
    "op10_pieces": piece.op10_pieces,
    "op11_centroids": centroids.op11_centroids,
    "op12_token_counts": tokencounts.op12_token_counts,
    "op13_divergence": divergence.op13_divergence,
}

ORACLE: dict[str, str] = chat.SQL | exact.SQL | topk.SQL | centroids.SQL | divergence.SQL
