"""Queries over the driver's tables."""

from . import more, queries

__all__ = ["more", "queries"]
