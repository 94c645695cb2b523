"""Half-even rounding, the rule used by every reported figure."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_even(value: Column | str, places: int = 0) -> Column:
    return F.bround(value, places)


def units_from_forecast(value: Column | str) -> Column:
    """Whole, non-negative units of a prediction."""
    col = F.col(value) if isinstance(value, str) else value
    return F.bround(F.greatest(col, F.lit(0.0)), 0).cast("bigint")
