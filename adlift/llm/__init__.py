"""Operators of a training-data pipeline: extraction, archives, filters, dedup, packing, tokens.

Nothing else in the library imports this package. Each operator module states how
it treats nulls, empty and very long texts, ties, repeated rows and empty tables.
"""
