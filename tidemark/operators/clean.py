"""Row filters and outlier capping of raw sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.quantiles import exact_quantiles
from tidemark.schema import SOLD_STATUSES


def is_sold() -> Column:
    return F.lower(F.trim("status")).isin(SOLD_STATUSES)


def filter_status(df: DataFrame) -> DataFrame:
    """Keep rows of sold orders; a table without a status column is kept whole."""
    return df.filter(is_sold()) if "status" in df.columns else df


def iqr_cap(df: DataFrame, name: str = "units_sold", weight: str | None = None) -> DataFrame:
    """One row ``cap``: third quartile plus 1.5 times the interquartile range of the whole
    table, NULL for ten rows or fewer."""
    stats = exact_quantiles(df, name, [0.25, 0.75], weight)
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    return stats.select(F.when(F.col("n") > 10, q3 + 1.5 * (q3 - q1)).alias("cap"))


def clip_iqr(df: DataFrame, name: str = "units_sold", cap: float | None = None) -> DataFrame:
    """Cap high values (never low ones). The result is a double, since a cap may be fractional.

    The cap is read back as one number. As a subquery it would be computed again wherever the
    optimizer moves the capped column to. The cap of another table may be passed instead.
    """
    return cap_at(df, cap if cap is not None else iqr_cap(df, name).first()["cap"], name)


def cap_at(df: DataFrame, cap: float | None, name: str = "units_sold") -> DataFrame:
    value = F.col(name).cast("double")
    if cap is None:
        return df.withColumn(name, value)
    return df.withColumn(name, F.when(value > cap, F.lit(float(cap))).otherwise(value))


def keep_positive(df: DataFrame, name: str = "units_sold") -> DataFrame:
    return df.filter(F.col(name) > 0)


def filter_sku(df: DataFrame, sku: str | Column) -> DataFrame:
    return df.filter(F.col("sku_id") == sku)
