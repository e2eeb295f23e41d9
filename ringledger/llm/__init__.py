"""Operators for large text corpora, their queries and the SQL beside them."""

from ringledger.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
