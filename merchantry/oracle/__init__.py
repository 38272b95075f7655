"""The same tables and questions as SQL for an independent engine, to compare with."""

from .questions import oracle_queries

__all__ = ["oracle_queries"]
