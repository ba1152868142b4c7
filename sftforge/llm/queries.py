"""The subpackage's driver queries and the SQL of those that SQL can express."""

from __future__ import annotations

from sftforge.llm import (
    chat, convrepair, decontaminate, hardneg, htmltext, linededup, lmscore, packing, secrets, simhash, suffixes, topk, toxicity)

QUERIES = {
    "op1_typed_chat_parts": chat.op1_typed_chat_parts,
    "op2_suffix_array_dedup": suffixes.op2_suffix_array_dedup,
    "op3_spaced_seed_decontamination": decontaminate.op3_spaced_seed_decontamination,
    "op4_backoff_automaton": lmscore.op4_backoff_automaton,
    "op5_power_of_two_packing": packing.op5_power_of_two_packing,
    "op6_crf_secrets": secrets.op6_crf_secrets,
    "op7_kneser_ney_toxicity": toxicity.op7_kneser_ney_toxicity,
    "op8_simhash_pigeonhole": simhash.op8_simhash_pigeonhole,
    "op9_segment_line_dedup": linededup.op9_segment_line_dedup,
    "op10_impact_ordered_topk": topk.op10_impact_ordered_topk,
    "op11_repair_grammar_conversations": convrepair.op11_repair_grammar_conversations,
    "op12_tree_model_extraction": htmltext.op12_tree_model_extraction,
    "op13_threshold_hard_negatives": hardneg.op13_threshold_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op1_typed_chat_parts": chat.SQL,
    "op2_suffix_array_dedup": suffixes.SQL,
    "op10_impact_ordered_topk": topk.SQL,
    "op11_repair_grammar_conversations": convrepair.SQL,
    "op13_threshold_hard_negatives": hardneg.SQL,
}
