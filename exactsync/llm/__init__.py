"""Operators of a training-data pipeline: mixing, deduplication, classifiers, token counts, packing, search.

Nothing outside this subpackage imports it.
"""
