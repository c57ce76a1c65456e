"""Operators of a training-data pipeline: filters, deduplication, mixing, scoring, token output."""
