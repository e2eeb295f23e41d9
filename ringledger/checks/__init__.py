"""Check queries over the star-schema, event, page and conversation tables, each with its SQL counterpart."""

from ringledger.checks.registry import ORACLES, QUERIES
from ringledger.checks import conversations, load, pages, records, reports, scalars  # noqa: F401
from ringledger.checks import selection, site, storage, streams  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
