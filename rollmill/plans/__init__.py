"""The registered queries of the curation operators."""

from rollmill.plans import catalogue, decisions, intake, runs  # noqa: F401
from rollmill.plans.registry import Query
from rollmill.plans.registry import registered as queries
from rollmill.plans.registry import registered_sql as oracle_sql

__all__ = ["Query", "oracle_sql", "queries"]
