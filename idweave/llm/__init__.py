"""Operators of a training-data pipeline (deduplication, quality, tokens, packing, mixing, WARC).

Nothing else in the library imports this subpackage. Each operator has its
own module and general interface; ``queries`` applies them to whole tables
with production parameters.
"""
