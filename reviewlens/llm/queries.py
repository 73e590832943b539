"""The registered queries of the operators, and their SQL where it can express them."""

from __future__ import annotations

from reviewlens.llm import (
    chat,
    decontaminate,
    fill_middle,
    language,
    line_dedup,
    mixing,
    quality_fm,
    quality_rules,
    sharding,
    simhash,
    spelling,
    suffix_dedup,
    topk_search,
)

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_quality_fm": quality_fm.op2_quality_fm,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_sharding": sharding.op4_sharding,
    "op5_language": language.op5_language,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_mixing": mixing.op7_mixing,
    "op8_chat": chat.op8_chat,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_topk_search": topk_search.op11_topk_search,
    "op12_fill_middle": fill_middle.op12_fill_middle,
    "op13_spelling": spelling.op13_spelling,
}

SQL: dict[str, str] = {
    "op3_line_dedup": line_dedup.SQL,
    "op7_mixing": mixing.SQL,
    "op8_chat": chat.SQL,
    "op11_topk_search": topk_search.SQL,
    "op12_fill_middle": fill_middle.SQL,
    "op13_spelling": spelling.SQL,
}
