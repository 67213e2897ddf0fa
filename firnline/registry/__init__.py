"""Registered queries over the driver tables."""

from importlib import import_module

_MODULES = (
    "job_queries", "product_queries", "pixel_queries", "series_queries", "spatial_queries", "source_queries",
    "stream_queries",
)


def load():
    """All queries and their SQL, keyed by name."""
    for name in _MODULES:
        import_module(f"firnline.registry.{name}")
    from firnline.registry.core import ORACLE, QUERIES

    return QUERIES, ORACLE
