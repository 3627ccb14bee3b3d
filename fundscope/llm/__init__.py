"""Operators of a training-data pipeline: deduplication, filters, search, mixing, output.

Nothing else in the library imports this package.
"""
