"""Registered queries, each next to the SQL it must agree with."""

from . import display, explore, gold, history, jobs, quality, sources, typing  # noqa: F401
from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
