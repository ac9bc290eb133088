"""Registered queries, by step of the work."""

from __future__ import annotations

from types import ModuleType


def load() -> ModuleType:
    """Import every query module and return the registry."""
    from sonoloom.plans import (  # noqa: F401
        batching,
        cataloguing,
        io_queries,
        publishing_queries,
        quality_queries,
        reconciling,
        registry,
        segment_queries,
        selecting,
        sink_queries,
        vector_queries,
    )

    return registry
