"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from ledgerlens.llm import collocations, lexical_search, preference_format, vector_dedup, warc_dict

#: query: module
MODULES = {
    "op1_subword_lm": "subword_lm",
    "op2_vector_dedup": "vector_dedup",
    "op3_slack_packing": "slack_packing",
    "op4_simhash_dedup": "simhash_dedup",
    "op5_preference_format": "preference_format",
    "op6_quality_rules": "quality_rules",
    "op7_matrix_packing": "matrix_packing",
    "op8_warc_dict": "warc_dict",
    "op9_mixing": "mixing",
    "op10_pu_quality": "pu_quality",
    "op11_weighted_sampling": "weighted_sampling",
    "op12_lexical_search": "lexical_search",
    "op13_collocations": "collocations",
}
QUERIES: dict[str, Callable] = {
    name: getattr(import_module(f"ledgerlens.llm.{module}"), name) for name, module in MODULES.items()}
ORACLES: dict[str, str] = {
    "op2_vector_dedup": vector_dedup.OP2_SQL,
    "op5_preference_format": preference_format.OP5_SQL,
    "op8_warc_dict": warc_dict.OP8_SQL,
    "op12_lexical_search": lexical_search.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
