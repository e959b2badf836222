"""Operators of a training-data pipeline: filters, near-duplicates, mixing, packing, search.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; ``queries`` registers the thin queries over the
test tables.
"""
