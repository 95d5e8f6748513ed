"""Operators for training-data pipelines: pages, documents and vectors to clean, deduplicated, packed text."""
