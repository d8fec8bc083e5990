"""Readers and writers for series, labels, feature matrices, metadata and messages."""
