"""Imports the modules that register queries."""

import subspan.llm.op1_quality
import subspan.llm.op2_toxicity
import subspan.llm.op3_minhash
import subspan.llm.op4_mix
import subspan.llm.op5_decontaminate
import subspan.llm.op6_extract
import subspan.llm.op7_language
import subspan.llm.op8_topk
import subspan.llm.op9_token_counts
import subspan.llm.op10_token_output
import subspan.llm.op11_runs
import subspan.llm.op12_licenses
import subspan.llm.op13_divergence  # noqa: F401
from subspan.llm.registry import QUERIES, SQL  # noqa: F401
