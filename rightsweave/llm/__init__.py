"""Operators for preparing training data (mixing, deduplication, search, formatting, packing, scoring).

Nothing else in the library imports this subpackage.
"""
