"""Query plans over the driver tables, each paired with a SQL oracle."""

from .catalog import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
