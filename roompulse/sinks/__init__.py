"""Batch and streaming outputs."""
