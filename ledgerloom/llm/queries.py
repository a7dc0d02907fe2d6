"""Queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from ledgerloom.llm.bpe import op13_bpe
from ledgerloom.llm.decontaminate import op5_decontaminate
from ledgerloom.llm.language import op7_language
from ledgerloom.llm.licenses import op3_licenses
from ledgerloom.llm.packing import op4_packing
from ledgerloom.llm.phrases import OP12_SQL, op12_collocations
from ledgerloom.llm.runs import op11_periodic_runs
from ledgerloom.llm.secrets import op2_secrets
from ledgerloom.llm.simhash import op1_simhash
from ledgerloom.llm.topk import OP8_SQL, op8_topk
from ledgerloom.llm.toxicity import op9_toxicity
from ledgerloom.llm.urls import OP6_SQL, op6_url_filter
from ledgerloom.llm.wrappers import op10_main_text

_OPERATORS = (op1_simhash, op2_secrets, op3_licenses, op4_packing, op5_decontaminate, op6_url_filter, op7_language, op8_topk, op9_toxicity, op10_main_text, op11_periodic_runs, op12_collocations, op13_bpe)
QUERIES = {f.__name__: f for f in _OPERATORS}
ORACLES = {"op6_url_filter": OP6_SQL, "op8_topk": OP8_SQL, "op12_collocations": OP12_SQL}
