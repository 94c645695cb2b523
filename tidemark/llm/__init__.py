"""Operators of a training-data pipeline over document, page, benchmark and label tables.

Nothing else in the library imports this subpackage. ``QUERIES`` and ``ORACLES`` hold the queries
and their SQL counterparts.
"""

from tidemark.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
