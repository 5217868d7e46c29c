"""Registered queries of the corpus operators and their DuckDB twins (only where SQL expresses the operator)."""

from __future__ import annotations

from fuelsight.llm.alignment import op11_tokenizer_alignment
from fuelsight.llm.chat import ORACLE as CHAT_ORACLE
from fuelsight.llm.chat import op8_chat_formatting
from fuelsight.llm.decontaminate import op1_benchmark_decontamination
from fuelsight.llm.jaccard import op9_ngram_jaccard_join
from fuelsight.llm.language import op4_language_id
from fuelsight.llm.middle import ORACLE as MIDDLE_ORACLE
from fuelsight.llm.middle import op12_fill_in_middle
from fuelsight.llm.packing import op3_packing
from fuelsight.llm.quality import op2_quality_rules
from fuelsight.llm.scoring import op10_lm_scoring
from fuelsight.llm.sharding import op5_sharding
from fuelsight.llm.sharding import oracle as sharding_oracle
from fuelsight.llm.substrings import op7_substring_dedup
from fuelsight.llm.toxicity import op13_toxicity
from fuelsight.llm.warc import ORACLE as WARC_ORACLE
from fuelsight.llm.warc import op6_warc

QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_quality_rules": op2_quality_rules,
    "op3_packing": op3_packing,
    "op4_language_id": op4_language_id,
    "op5_sharding": op5_sharding,
    "op6_warc": op6_warc,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_toxicity": op13_toxicity,
}

ORACLE: dict[str, str] = {
    "op5_sharding": sharding_oracle(),
    "op8_chat_formatting": CHAT_ORACLE,
    "op6_warc": WARC_ORACLE,
    "op12_fill_in_middle": MIDDLE_ORACLE,
}
