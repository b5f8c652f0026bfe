"""Operators of a training-data pipeline: deduplication, mixing, tokens, filters, extraction."""
