"""Registered queries of this subpackage and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from flowguard.llm.decontaminate import op8_decontaminate
from flowguard.llm.host_rules import OP9_SQL, op9_host_rules
from flowguard.llm.licences import OP3_SQL, op3_licences
from flowguard.llm.lm import op6_lm_scores
from flowguard.llm.merkle import OP13_SQL, op13_manifest
from flowguard.llm.mixing import OP2_SQL, op2_source_mix
from flowguard.llm.near_dup import op10_near_duplicates
from flowguard.llm.phrases import OP12_SQL, op12_phrases
from flowguard.llm.quality import op5_quality
from flowguard.llm.revisits import OP7_SQL, op7_revisits
from flowguard.llm.sharding import op4_shards
from flowguard.llm.tokens import op1_token_counts
from flowguard.llm.toxicity import op11_toxicity

LLM_QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_source_mix": op2_source_mix,
    "op3_licences": op3_licences,
    "op4_shards": op4_shards,
    "op5_quality": op5_quality,
    "op6_lm_scores": op6_lm_scores,
    "op7_revisits": op7_revisits,
    "op8_decontaminate": op8_decontaminate,
    "op9_host_rules": op9_host_rules,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_toxicity": op11_toxicity,
    "op12_phrases": op12_phrases,
    "op13_manifest": op13_manifest,
}

LLM_ORACLE: dict[str, str] = {
    "op2_source_mix": OP2_SQL,
    "op3_licences": OP3_SQL,
    "op7_revisits": OP7_SQL,
    "op9_host_rules": OP9_SQL,
    "op12_phrases": OP12_SQL,
    "op13_manifest": OP13_SQL,
}
