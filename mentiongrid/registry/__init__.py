"""All registered queries, by survey section."""

from mentiongrid.registry import aggregates, dictionaries, filters, ingestion, joins, matching, sinks, sources  # noqa: F401
from mentiongrid.registry.base import REGISTRY

__all__ = ["REGISTRY"]
