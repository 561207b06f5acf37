"""Registry of the named queries over the driver's tables."""

from plinth.plans import enrichment, events, gates, joins, ledger, places, texts  # noqa: F401
from plinth.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
