"""Calendar features of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def calendar_features(df: DataFrame, day: str = "date") -> DataFrame:
    """Day of week (Monday = 0) and its weekly and yearly phase."""
    week = 2 * F.pi() * F.weekday(day) / 7
    year = 2 * F.pi() * F.dayofyear(day) / 365.25
    return df.withColumns({
        "dow": F.weekday(day),
        "dow_sin": F.sin(week), "dow_cos": F.cos(week),
        "doy_sin": F.sin(year), "doy_cos": F.cos(year),
    })
