"""Forecast calendar, bridging of the recent gap and allocation to products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.calendar import calendar_features
from tidemark.schema import DAYS_PER_QUARTER
from tidemark.session import ensure_checkpoint_dir


def plan_horizon(history_end: DataFrame, as_of: str | Column, quarters: int | Column) -> DataFrame:
    """Forecast calendar from the last day of history (column ``last_date``).

    History is taken to be bridged up to the day before ``as_of``. Before the 28th of a month
    the forecast starts with the next month, and the skipped days shorten it.
    """
    today = (F.lit(as_of) if isinstance(as_of, str) else as_of).cast("date")
    days = (F.lit(quarters) if isinstance(quarters, int) else quarters) * DAYS_PER_QUARTER
    next_month = F.add_months(F.trunc(today, "MM"), 1)
    bridged = history_end.withColumns({
        "bridged_days": F.greatest(F.date_diff(F.date_add(today, -1), "last_date"), F.lit(0)),
        "bridged_to": F.greatest(F.col("last_date"), F.date_add(today, -1)),
        "total_days": days})
    ahead = F.date_diff(next_month, "bridged_to") - 1
    skip = F.when((F.dayofmonth(today) < 28) & (ahead > 0) & (ahead < F.col("total_days")), ahead).otherwise(0)
    return bridged.withColumn("days_to_skip", skip).withColumns({
        "forecast_days": F.col("total_days") - F.col("days_to_skip"),
        "first_label": F.date_add(F.col("bridged_to"), F.col("days_to_skip") + 1)})


def bridge_days(daily: DataFrame, as_of: str | Column) -> DataFrame:
    """For each series the missing days up to the day before ``as_of``, filled from the historic
    day nearest to one year earlier. History is dense, so nearest means clamped to its ends."""
    today = (F.lit(as_of) if isinstance(as_of, str) else as_of).cast("date")
    ends = daily.groupBy("series_id").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    gap = (ends.filter(F.col("hi") < F.date_add(today, -1))
           .withColumn("day", F.explode(F.sequence(F.date_add("hi", 1), F.date_add(today, -1))))
           .select("series_id", "day",
                   F.least(F.greatest(F.add_months("day", -12), F.col("lo")), F.col("hi")).alias("date")))
    source = daily.select("series_id", "date", "total_units", "avg_price", "promo_any")
    return gap.join(source, ["series_id", "date"]).select(
        "series_id", F.col("day").alias("date"), "total_units", "avg_price", "promo_any")


def bridge_gap(daily: DataFrame, as_of: str | Column) -> DataFrame:
    """History followed by the bridged days, calendar features recomputed for every day."""
    plain = daily.select("series_id", "date", "total_units", "avg_price", "promo_any")
    return calendar_features(plain.unionByName(bridge_days(daily, as_of)))


def sku_shares(rows: DataFrame, recent_days: int = 28) -> DataFrame:
    """Share of each product in the units of the last days; all-time share when those sold
    nothing, equal shares when nothing was ever sold. The rows are read once: their sums per product
    and day are stored, and the last day and both totals come from those."""
    ensure_checkpoint_dir(rows.sparkSession)
    per_day = rows.groupBy("sku_id", "date").agg(F.sum("units_sold").alias("units_sold")).checkpoint()
    cut = per_day.agg(F.date_sub(F.max("date"), recent_days).alias("cut")).scalar()
    sums = per_day.groupBy("sku_id").agg(
        F.coalesce(F.sum(F.when(F.col("date") > cut, F.col("units_sold"))), F.lit(0)).alias("recent"),
        F.coalesce(F.sum("units_sold"), F.lit(0)).alias("ever"))
    # Totals as a scalar subquery, not an unpartitioned window: the product list may be long.
    totals = sums.agg(F.struct(F.sum("recent").alias("recent"), F.sum("ever").alias("ever"),
                               F.count(F.lit(1)).alias("n")).alias("t")).scalar()
    t = sums.withColumn("t", totals)
    share = (F.when(F.col("t.recent") > 0, F.try_divide("recent", F.col("t.recent").cast("double")))
             .when(F.col("t.ever") > 0, F.try_divide("ever", F.col("t.ever").cast("double")))
             .otherwise(1.0 / F.col("t.n")))
    return t.select("sku_id", share.alias("share"))


def allocate(total: DataFrame, shares: DataFrame) -> DataFrame:
    """Spread the one total forecast over products.

    The forecast has one value per day of the horizon, so it travels as one array; the product
    list stays partitioned and is never broadcast.
    """
    packed = total.agg(F.array_sort(F.collect_list(
        F.struct("date", F.col("predicted_units").alias("units")))).alias("days")).scalar()
    return shares.withColumn("d", F.explode(packed)).select(
        "sku_id", F.col("d.date").alias("date"),
        (F.col("d.units") * F.col("share")).alias("predicted_units"))
