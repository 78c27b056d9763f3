"""Queries over the given tables, one per operator, with the SQL they must equal."""

from . import dense, incremental, quality, rules, shop, storage  # noqa: F401  (each module registers its queries)
from .data import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
