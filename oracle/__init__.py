"""Equivalent SQL for every registered query, for a second engine."""

from .phases import build

__all__ = ["build"]
