"""Operators for preparing training corpora: filters, deduplication, tokens, search and packing.

Nothing outside this package (and the pipeline module at the top of the repository) imports it.
"""
