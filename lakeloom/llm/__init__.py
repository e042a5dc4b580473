"""Operators for training-data pipelines: filters, extraction, dedup, mixing, sharding."""
