"""Operators on text corpora: deduplication, tokens, mixing, quality and safety scans.

Each module holds one operator with its own general interface; ``registry``
lists the queries over the given tables.
"""
