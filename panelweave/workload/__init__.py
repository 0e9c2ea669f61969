"""Registered queries: every operator run over the given tables, each with its SQL counterpart."""

from panelweave.workload import catalogue, joining, published, recodes, reshaping, study_rules  # noqa: F401
from panelweave.workload.registry import QUERIES, SQL

published.register_stored_counts()

__all__ = ["QUERIES", "SQL"]
