"""All registered queries."""

from __future__ import annotations

from changeflow.plans import (  # noqa: F401
    queries_audit,
    queries_changelog,
    queries_declared,
    queries_format,
    queries_monitor,
    queries_route,
    queries_stream,
)
from changeflow.plans.registry import QUERIES

__all__ = ["QUERIES"]
