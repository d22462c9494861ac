"""Compositions: the binding of the test tables, the refresh, and the registered queries."""

from __future__ import annotations

from collections.abc import Callable


def all_queries() -> tuple[dict[str, Callable], dict[str, str]]:
    """Registered queries and their oracle SQL, by name."""
    from freightlens.plans import columns, loads, reports, stars  # noqa: F401
    from freightlens.plans.registry import ORACLE, QUERIES

    return dict(QUERIES), dict(ORACLE)
