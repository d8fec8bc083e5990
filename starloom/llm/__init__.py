"""Operators for text corpora."""
