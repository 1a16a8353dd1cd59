"""Operators for large training corpora: quality, personal data, deduplication, tokens, mixing, packing, toxicity."""
