"""The operators as named queries over the given tables, each with equivalent SQL."""

from __future__ import annotations

from scholarmart.suite.registry import QUERIES, SQL


def load() -> None:
    """Import every part, which fills the registry."""
    from scholarmart.suite import (  # noqa: F401
        aggregates,
        columns,
        dashboards,
        joins,
        mining,
        pipelines,
        quality,
        search,
        selection,
        streams,
        writes,
    )


__all__ = ["QUERIES", "SQL", "load"]
