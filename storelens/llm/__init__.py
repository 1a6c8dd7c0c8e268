"""Operators of a training-data pipeline: dedup, packing, tokenising, scoring, search."""
