"""Operators for preparing training data: archives, filters, deduplication, mixing, sharding and scoring."""
