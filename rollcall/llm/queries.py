"""The driver queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from rollcall.llm.class_lm import op11_lm_scoring
from rollcall.llm.conversation_repair import op13_conversation_repair
from rollcall.llm.mixing import op7_mixing
from rollcall.llm.ngram_join import op10_ngram_jaccard_join
from rollcall.llm.pieces import op8_sentencepiece
from rollcall.llm.quality import op4_quality_rules
from rollcall.llm.quotes import op2_quotation_linking
from rollcall.llm.sharding import op1_sharding
from rollcall.llm.spelling import op12_spelling_variants
from rollcall.llm.substring_dedup import op3_substring_dedup
from rollcall.llm.toxicity import op9_toxicity
from rollcall.llm.vector_join import op6_embedding_near_dedup
from rollcall.llm.warc import op5_warc

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_quotation_linking": op2_quotation_linking,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_warc": op5_warc,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_mixing": op7_mixing,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_toxicity": op9_toxicity,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}
