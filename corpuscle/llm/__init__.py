"""Operators for training data: filters, near duplicates, extraction and tokens."""
