"""All checked queries in one place."""

from lodestream.plans import (  # noqa: F401
    catalog_data,
    catalog_pairs,
    catalog_retrieval,
    catalog_sources,
    catalog_streaming,
    catalog_telemetry,
)
from lodestream.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
