"""Operators for preparing training data: archives, dedup, filters, mixes and tokens."""
