"""Operators for training-data pipelines: packing, counting, filtering, deduplication and scoring of texts."""
