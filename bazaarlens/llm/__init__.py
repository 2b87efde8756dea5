"""Operators and queries for preparing training text and vectors.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` depends on it.
"""
