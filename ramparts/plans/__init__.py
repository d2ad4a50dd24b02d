"""Registered queries and the SQL that states their results independently."""

from ramparts.plans.catalogue import QUERIES
from ramparts.plans.statements import STATEMENTS

__all__ = ["QUERIES", "STATEMENTS"]
