"""Operators for training-data pipelines: packing, filters, sharding, extraction, fingerprints, dedup, tokenization."""
