"""All queries by name."""

from conduit.plans import (  # noqa: F401  (importing registers the queries)
    catalogue_functions,
    catalogue_keys,
    catalogue_records,
    catalogue_streams,
    catalogue_transfer,
)
from conduit.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
