"""Composed pipelines and the registry of queries over the sample tables."""
