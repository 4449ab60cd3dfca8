"""Training-data operators: deduplication, decontamination, scoring, tokenising, sharding, extraction.

Nothing else in the library imports this subpackage.
"""
