"""Questions to intents by keyword, first match wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens import fixed_values as fixed
from bazaarlens.functions.text import contains_any


def _outcome(intent: str, confidence: float) -> Column:
    return F.struct(F.lit(intent).alias("intent"), F.lit(confidence).alias("confidence"))


def _first_match(text: Column, rules, otherwise: Column | None = None) -> Column:
    """A CASE over the rules in order; a rule without terms always matches."""
    chain = None
    for intent, confidence, terms in rules:
        hit = contains_any(text, terms) if terms else F.lit(True)
        outcome = _outcome(intent, confidence)
        chain = F.when(hit, outcome) if chain is None else chain.when(hit, outcome)
    return chain if otherwise is None else chain.otherwise(otherwise)


def classify(df: DataFrame, text: str) -> DataFrame:
    """Add ``intent`` and ``confidence``. Matching is on substrings of the lower-cased text."""
    lowered = df.withColumn("_text", F.lower(F.col(text)))
    t = F.col("_text")
    listed = F.when(contains_any(t, fixed.ITEM_LIST_TERMS), _first_match(t, fixed.ITEM_INTENTS))
    seller = F.coalesce(listed, _first_match(t, fixed.SELLER_INTENTS))
    market = _first_match(t, fixed.MARKET_INTENTS, _outcome(*fixed.UNKNOWN_INTENT))
    found = F.when(contains_any(t, fixed.SELLER_TERMS), seller).otherwise(market)
    return lowered.withColumn("_found", found).select(*df.columns, "_found.intent", "_found.confidence")
