"""Operators for large training-text corpora.

Each module holds one operator with its own general interface; ``queries``
holds the thin registered queries.  Nothing outside this package imports it.
"""
