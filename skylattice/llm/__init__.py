"""Operators for preparing training text: deduplication, filters, tokens, models.

Nothing else in the library imports this package.
"""
