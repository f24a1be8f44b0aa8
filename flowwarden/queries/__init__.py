"""The registered queries: each operator over the given tables, with its SQL twin where one exists."""

from flowwarden.queries import alert_reads, functions, models, preparation, streams, tables  # noqa: F401
from flowwarden.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
