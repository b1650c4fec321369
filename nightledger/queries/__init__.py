"""Registered queries over the given tables, each with its check in SQL."""

from nightledger.queries import (  # noqa: F401  (importing a module registers its queries)
    channels,
    dwell,
    income,
    merges,
    quality,
    reports,
    signup,
    spend,
)
from nightledger.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
