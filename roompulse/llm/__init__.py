"""Operators for training-data pipelines, and the queries that apply them to the corpus tables."""
