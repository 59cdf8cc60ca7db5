"""Training-data operators: deduplication, packing, scanning, scoring and formatting of documents.

Nothing outside this package imports it, so it can be removed as a whole.
"""
