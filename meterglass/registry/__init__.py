"""All registered queries and their SQL."""

from meterglass.registry.common import ORACLES, QUERIES
from meterglass.registry import summary, tracking, behavior, deck, reports, ingest  # noqa: F401
from meterglass.registry import relational, windows, scalars  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
