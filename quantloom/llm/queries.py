"""The registered queries of the numbered operators and the SQL of those that SQL can express."""

from __future__ import annotations

from quantloom.llm.chat import OP1_SQL, op1_preferences
from quantloom.llm.decontaminate import OP2_SQL, op2_decontamination
from quantloom.llm.html_text import op6_html_text
from quantloom.llm.jaccard_join import OP12_SQL, op12_jaccard_join
from quantloom.llm.language import op3_language
from quantloom.llm.merkle import OP11_SQL, op11_merkle_manifest
from quantloom.llm.mixing import MIX_TARGETS_SQL, mix_targets, op9_mixing
from quantloom.llm.near_dedup import op8_near_duplicates
from quantloom.llm.periodic_runs import op13_periodic_runs
from quantloom.llm.pii import BASE_SQL, base_personal_data, op10_pii
from quantloom.llm.quality import op4_quality
from quantloom.llm.quality_rules import COUNTS_SQL, op7_quality_rules, quality_counts
from quantloom.llm.substring_dedup import OP5_SQL, op5_substring_dedup

NUMBERED = (
    op1_preferences, op2_decontamination, op3_language, op4_quality, op5_substring_dedup, op6_html_text, op7_quality_rules, op8_near_duplicates, op9_mixing, op10_pii, op11_merkle_manifest,
    op12_jaccard_join, op13_periodic_runs,
)
#: The parts of op7, op9 and op10 that SQL can express, so that they too are held against an oracle.
PARTS = (quality_counts, mix_targets, base_personal_data)
QUERIES = {f.__name__: f for f in (*NUMBERED, *PARTS)}
ORACLE_SQL = {
    "op1_preferences": OP1_SQL, "op2_decontamination": OP2_SQL, "op5_substring_dedup": OP5_SQL, "quality_counts": COUNTS_SQL, "mix_targets": MIX_TARGETS_SQL, "base_personal_data": BASE_SQL, "op11_merkle_manifest": OP11_SQL,
    "op12_jaccard_join": OP12_SQL,
}
