"""One module per group of operators; importing the package fills the registry."""

from . import (  # noqa: F401
    aggregates,
    checks,
    dimensions,
    facts,
    filters,
    functions,
    history,
    joins,
    ordering,
    people,
    projections,
    sources,
    temporal,
    upserts,
    windows,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
