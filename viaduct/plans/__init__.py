"""Queries over the provided tables, each with the SQL that gives the same result."""

from . import forecasts, joins, quality, reports, scalars, serving, storage, streams  # noqa: F401
from . import jobs  # noqa: F401  reuses the SQL of the others
from .catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
