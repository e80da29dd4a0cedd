"""Queries over the supplied tables, each next to the SQL that checks it."""

from umbu.queries import bronze, catalog, functions, gold, joins, rows, scans, silver  # noqa: F401
from umbu.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
