"""Operators for training-data pipelines over document and embedding tables."""
