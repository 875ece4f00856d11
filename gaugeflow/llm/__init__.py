"""Operators of a training-data pipeline: scoring, deduplication, joins, privacy, tokens, archives."""
