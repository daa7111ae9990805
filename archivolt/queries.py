"""Named queries over the driver's tables, and their SQL twins."""

from __future__ import annotations

from archivolt import queries_core, queries_data, queries_more, queries_ops  # noqa: F401  (they register themselves)
from archivolt.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    """Every core query by name."""
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB statements of those that SQL can express."""
    return dict(SQL)
