"""Jobs and the registry of named queries (with their SQL oracles)."""

from retention.plans import registry
from retention.plans import price_queries  # noqa: F401  (registers queries)
from retention.plans import table_queries  # noqa: F401
from retention.plans import model_queries  # noqa: F401
from retention.plans import source_queries  # noqa: F401

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES

__all__ = ["QUERIES", "ORACLES", "registry"]
