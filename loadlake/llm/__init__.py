"""Operators for preparing training text: filtering, deduplication, extraction, labelling, counting and packing."""
