"""From sales rows to gap-free daily series.

Raw rows are aggregated per series and day before anything is ordered: a window partition
therefore holds one row per calendar day, however many rows a product has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.functions.calendar import calendar_features
from tidemark.schema import ALL_SERIES


def by_day() -> WindowSpec:
    return Window.partitionBy("series_id").orderBy("date")


def with_series(df: DataFrame, by: str | Column | None = None) -> DataFrame:
    """Name the series of each row: one per value of ``by``, or the single total series."""
    if by is None:
        key = F.lit(ALL_SERIES)
    else:
        key = (F.col(by) if isinstance(by, str) else by).cast("string")
    return df.withColumn("series_id", key)


def daily_aggregate(df: DataFrame) -> DataFrame:
    """Per series and day: units, unweighted mean price, any promotion."""
    return df.groupBy("series_id", "date").agg(
        F.sum("units_sold").alias("total_units"),
        F.avg("price").alias("avg_price"),
        F.max("promotion_flag").alias("promo_any"))


def daily_total(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.sum("units_sold").alias("total_units"))


def densify_calendar(daily: DataFrame, carry_price: bool = False) -> DataFrame:
    """One row per calendar day between the first and last day of each series.

    Each observed day also emits the missing days up to the next observed one, so no calendar
    table and no join is needed. Missing days have no units, no promotion and no price, or with
    ``carry_price`` the price of the observed day before them.
    """
    return _spread(_with_gap(daily), carry_price)


def _with_gap(daily: DataFrame) -> DataFrame:
    """Observed days with the last of the missing days behind each."""
    following = F.coalesce(F.lead("date").over(by_day()), F.date_add("date", 1))
    return daily.withColumn("_last", F.date_add(following, -1))


def _spread(observed: DataFrame, carry_price: bool) -> DataFrame:
    spread = observed.withColumn("day", F.explode(F.sequence("date", "_last")))
    real = F.col("day") == F.col("date")
    return spread.select(
        "series_id", F.col("day").alias("date"),
        F.when(real, F.coalesce(F.col("total_units"), F.lit(0))).otherwise(0).cast("bigint").alias("total_units"),
        (F.col("avg_price") if carry_price else F.when(real, F.col("avg_price"))).alias("avg_price"),
        F.when(real, F.coalesce(F.col("promo_any"), F.lit(0))).otherwise(0).cast("int").alias("promo_any"))


def fill_price(daily: DataFrame, name: str = "avg_price") -> DataFrame:
    """Carry the last known price forward, then the first known price backward.

    A day with no earlier price can only take the first price of the whole series, so both
    frames are evaluated in one pass; a frame from each row to the end would be quadratic.
    """
    past = by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_day().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return daily.withColumn(name, F.coalesce(F.last(name, True).over(past), F.first(name, True).over(whole)))


def daily_series(rows: DataFrame, by: str | Column | None = None,
                 store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Aggregation, price fill, calendar and calendar features in one step.

    The price is filled on the observed days, each of which hands it on to the missing days behind it: only
    these are sorted, and the calendar streams through. A row without a day has no place in it.

    Where the series is used more than once, ``store`` writes the observed days and reads them back: the calendar
    streams from them in every use, without another shuffle, and is never written itself.
    """
    observed = _with_gap(fill_price(daily_aggregate(with_series(rows, by)).filter("date is not null")))
    return calendar_features(_spread(observed if store is None else store(observed), carry_price=True))


def first_difference(daily: DataFrame, name: str = "total_units") -> DataFrame:
    return daily.withColumn("diff", F.col(name) - F.lag(name, 1).over(by_day())).filter("diff is not null")


def seasonal_difference(daily: DataFrame, name: str = "total_units", season: int = 7,
                        d: int = 1, seasonal_d: int = 1) -> DataFrame:
    """Column ``w``: differenced ``d`` times at lag 1 and ``seasonal_d`` times at the season."""
    return daily.withColumn("w", difference(name, d, seasonal_d, season)).filter("w is not null")


def difference(name: str, d: int, seasonal_d: int, season: int = 7) -> Column:
    """Differences of order 0 or 1 as lags, so they share one ordered pass."""
    x = F.col(name).cast("double")

    def lag(k: int) -> Column:
        return F.lag(x, k).over(by_day())

    if d and seasonal_d:
        return x - lag(1) - lag(season) + lag(season + 1)
    if d:
        return x - lag(1)
    if seasonal_d:
        return x - lag(season)
    return x


MIN_TRAIN, MIN_TEST = 90, 7


def validate_length(train: DataFrame, test: DataFrame, min_train: int = MIN_TRAIN, min_test: int = MIN_TEST) -> None:
    """Refuse training where no series has enough days. A short series beside longer ones is no reason:
    it gets a plain model (see :func:`short_series` for the list)."""
    for label, frame, least in (("training", train, min_train), ("test", test, min_test)):
        days = frame.groupBy("series_id").count().agg(F.max("count")).first()[0] or 0
        if days < least:
            raise ValueError(f"{label} data too short: {days} days, at least {least} needed")


def short_series(daily: DataFrame, least: int) -> DataFrame:
    """Series with fewer days than ``least``."""
    return daily.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_days")).filter(F.col("n_days") < least)
