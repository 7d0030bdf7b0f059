"""Operators of a training-data pipeline: filters, deduplication, packing, models."""
