"""Queries over the order tables, each with the SQL that states its result."""

from gridledger.catalog.registry import ORACLES, QUERIES

# Importing the modules registers their queries.
from gridledger.catalog import forecasting, keysets, lookups, margins, updates  # noqa: F401,E402

__all__ = ["ORACLES", "QUERIES"]
