"""Training-data operators: quality, deduplication, extraction, formatting, mixing, sharding, archiving, tokenizing.

Nothing else in the package imports this one.
"""
