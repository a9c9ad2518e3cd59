"""Queries over the sample tables and their SQL twins."""

from . import control, extraction, models, streams  # noqa: F401  (fill the registry)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
