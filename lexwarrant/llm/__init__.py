"""Operators of a training-data pipeline: tokens, packing, deduplication, filters, mixing, media.

Nothing outside this subpackage imports it. Every operator takes a DataFrame with at least the
columns it names, ignores further columns, and returns a new DataFrame.
"""
