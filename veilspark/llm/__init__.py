"""Operators for preparing training data: sharding, counting, scoring, deduplicating and encoding text."""
