"""Registered queries and the SQL they are compared with."""

from scrubline.checks.oracle import ORACLE
from scrubline.checks.queries import QUERIES, flagship

__all__ = ["ORACLE", "QUERIES", "flagship"]
