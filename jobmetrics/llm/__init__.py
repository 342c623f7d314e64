"""Operators for training-data pipelines; nothing outside this package and corpus_pipeline.py imports it."""
