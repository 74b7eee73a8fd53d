"""Operators for training-data pipelines: deduplication, filters, scans and tokenizers over text tables."""
