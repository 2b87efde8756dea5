"""Imports every module that registers queries."""

from bazaarlens.llm import forest, language_model, licenses, middle, near_duplicates, packing, personal_data, pieces, quality_rules, repeats, spellings, top_k, toxicity  # noqa: F401
from bazaarlens.llm.registry import ORACLES, QUERIES  # noqa: F401
