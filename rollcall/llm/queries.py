"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from rollcall.llm.byte_bpe import op7_byte_bpe
from rollcall.llm.decontamination import op8_decontamination
from rollcall.llm.embedding_dups import OP5_SQL, op5_embedding_dups
from rollcall.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from rollcall.llm.importance import OP12_SQL, op12_importance_draw
from rollcall.llm.jaccard_join import OP2_SQL, op2_jaccard_join
from rollcall.llm.language_id import op10_language_id
from rollcall.llm.sharding import op6_sharding
from rollcall.llm.suffix_dedup import OP1_SQL, op1_suffix_dedup
from rollcall.llm.token_counts import op4_token_counts
from rollcall.llm.tool_calls import OP9_SQL, op9_tool_calls
from rollcall.llm.top_k import OP11_SQL, op11_top_k
from rollcall.llm.url_filters import OP3_SQL, op3_url_filters

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_url_filters": op3_url_filters,
    "op4_token_counts": op4_token_counts,
    "op5_embedding_dups": op5_embedding_dups,
    "op6_sharding": op6_sharding,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_decontamination": op8_decontamination,
    "op9_tool_calls": op9_tool_calls,
    "op10_language_id": op10_language_id,
    "op11_top_k": op11_top_k,
    "op12_importance_draw": op12_importance_draw,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": OP1_SQL,
    "op2_jaccard_join": OP2_SQL,
    "op3_url_filters": OP3_SQL,
    "op5_embedding_dups": OP5_SQL,
    "op9_tool_calls": OP9_SQL,
    "op11_top_k": OP11_SQL,
    "op12_importance_draw": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
