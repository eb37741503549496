"""Operators of a training-data pipeline, one per file; nothing else in the library imports them."""
