"""Training-data operators: scoring, deduplication, mixing, tokenizing, extraction, search.

Nothing outside this subpackage imports it.
"""
