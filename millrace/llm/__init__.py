"""Training-data operators: language ID, deduplication, mixing, formatting, extraction, encoding.

Nothing outside this subpackage imports it.
"""
