"""Registered queries over the given tables, each with a twin in plain SQL."""

from . import data, extraction, lookups, modelling, reporting, screening, series, streams
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
