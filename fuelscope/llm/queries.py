"""The queries of this subpackage and their SQL twins, by name."""

from . import language, lines, mix, near, packing, periods, pii, quality, spelling, substrings, tokenfile, topk, toxicity
from .common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
