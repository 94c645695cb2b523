"""Demand analytics and forecasting on sales tables, expressed as Spark DataFrame work.

Every public function takes and returns DataFrames. A *series* is identified by
``series_id``; the all-products total is simply the one series called ``'ALL'``, so the
same code serves one series and many millions.
"""

from tidemark.session import build_session

__all__ = ["build_session"]
