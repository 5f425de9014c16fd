"""Queries over the test tables: every operator and document plan, with the SQL it must agree with."""

from workload import documents, relational, scans, streams, sync
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "documents", "relational", "scans", "streams", "sync"]
