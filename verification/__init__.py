"""Checks of the library on the driver's tables: LMS-shaped views, the registered queries and their reference SQL."""

from verification import functions, io, jobs, operators, tables  # noqa: F401
from verification.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
