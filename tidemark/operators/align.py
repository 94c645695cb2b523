"""Joins of series on their day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEY = ["series_id", "date"]


def align(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Days present in both."""
    return actual.join(forecast, KEY, "inner")


def missing_regressors(horizon: DataFrame, regressors: DataFrame) -> DataFrame:
    """Forecast days without regressor values."""
    return horizon.join(regressors, KEY, "left_anti")


def require_regressors(horizon: DataFrame, regressors: DataFrame) -> None:
    row = missing_regressors(horizon, regressors).first()
    if row is not None:
        raise ValueError(f"no regressors for series {row['series_id']} on {row['date']}")


def residuals(daily: DataFrame, fitted: DataFrame, name: str = "total_units") -> DataFrame:
    """Column ``residuals``: observed minus fitted, zero on days without a fitted value."""
    gap = F.coalesce(F.col(name) - F.col("fitted"), F.lit(0.0))
    return daily.join(fitted.select(*KEY, "fitted"), KEY, "left").withColumn("residuals", gap).drop("fitted")


def hybrid_sum(linear: DataFrame, residual: DataFrame, only_both: bool = False) -> DataFrame:
    """Linear plus residual forecast. A day without residual forecast keeps its linear one, or is
    left out with ``only_both``."""
    both = linear.select(*KEY, F.col("predicted_units").alias("_a")).join(
        residual.select(*KEY, F.col("predicted_units").alias("_b")), KEY, "inner" if only_both else "left")
    return both.select(*KEY, (F.col("_a") + F.coalesce("_b", F.lit(0.0))).alias("predicted_units"))
