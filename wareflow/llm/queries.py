"""The queries of the training-data operators and, where SQL can express them, their oracle."""

from __future__ import annotations

from . import bpe, chat, html, jaccard, mixing, neardup, quality, repair, sharding, spelling, suffixes, toxicity, warc
from .oracle import ORACLE_SQL  # noqa: F401

QUERIES = {
    "op1_kd_shards": sharding.op1_kd_shards,
    "op2_quality": quality.op2_quality,
    "op3_chat_format": chat.op3_chat_format,
    "op4_near_duplicates": neardup.op4_near_duplicates,
    "op5_bpe": bpe.op5_bpe,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_main_text": html.op7_main_text,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_suffix_dedup": suffixes.op9_suffix_dedup,
    "op10_mixing": mixing.op10_mixing,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_warc": warc.op13_warc,
}
