"""Named queries over the benchmark tables, each with its plain SQL counterpart."""

from tidemark.catalog.base import ORACLES, QUERIES
from tidemark.catalog import cleaning, evaluation, joins, models, reports, statistics, summaries, windows  # noqa: F401

__all__ = ["QUERIES", "ORACLES"]
