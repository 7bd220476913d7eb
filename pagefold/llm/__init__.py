"""Operators of a training-data pipeline: mixing, filtering, deduplication, counting, sharding."""
