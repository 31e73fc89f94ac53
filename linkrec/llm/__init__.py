"""Operators of a training-data pipeline (sharding, near-dedup, mixing, ...)."""
