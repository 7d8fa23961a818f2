"""Registered queries: every operator applied to the given tables, with the SQL its result must equal."""

from cohortspark.catalog import (  # noqa: F401
    q_aggregates,
    q_clean,
    q_composite,
    q_encode,
    q_joins,
    q_models,
    q_scalars,
    q_sources,
)
from cohortspark.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
