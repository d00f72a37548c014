"""Registered queries: importing this package fills the registry."""

from parkwright.plans import chunks, columns, rates, scans, sets  # noqa: F401
from parkwright.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
