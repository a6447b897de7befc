"""Operators for building training data: quality, extraction, near-duplicates, decontamination, tokens, archives."""
