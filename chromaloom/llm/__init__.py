"""Operators of a training-data pipeline: extraction, deduplication, quality, packing, formats."""
