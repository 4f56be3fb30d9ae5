"""Registered queries over the driver tables, each with an equivalent SQL text where one exists."""

from riskloom.queries import modelling, ordered, plans, quality, scalar, tables  # noqa: F401
from riskloom.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
