"""All registered queries."""

from . import aggregates, columns, files, jobs, matches, ranks, texts  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
