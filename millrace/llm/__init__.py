"""Operators of a training-data pipeline: deduplication, secret scans, packing,
tokenisation, language-model scoring, media columns and quality votes."""
