"""Operators for preparing training data: filtering, deduplication, scoring, tokens, packing."""
