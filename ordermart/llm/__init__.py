"""Operators for training-data pipelines over document, page and embedding tables."""
