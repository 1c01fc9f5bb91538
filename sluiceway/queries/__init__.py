"""Every query that can be run by name, each with the SQL it is checked against."""

from sluiceway.queries import history, marts, parts, reports, streams  # noqa: F401
from sluiceway.queries.registry import QUERIES

__all__ = ["QUERIES"]
