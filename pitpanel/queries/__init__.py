"""Registered queries, one or more for each operator, and their SQL."""

from . import inputs, joins, runs, series  # noqa: F401  they register
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
