"""Exploratory, variant and stationarity reports as named tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import eda, stationarity
from tidemark.operators.report import trailing_average
from tidemark.operators.series import daily_total, densify_calendar, daily_aggregate, first_difference, with_series
from tidemark.session import ensure_checkpoint_dir


def explore(rows: DataFrame) -> dict[str, DataFrame]:
    """Everything the exploratory report shows for the rows of a file (see ``raw_rows``).

    Profile and sample read the rows; all else comes from one stored table of sums per product,
    day and promotion flag.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    dated = rows.filter("date is not null")
    sums = eda.day_partials(dated).checkpoint()
    lift = eda.promo_lift_of(sums)
    return {
        "profile": eda.profile(rows),
        "per_sku_summary": eda.per_sku_summary_of(sums),
        "promo_summary": eda.rounded_lift(lift),
        "daily_total": daily_total(sums),
        "trailing_average": trailing_average(sums),
        "weekday_profile": eda.weekday_profile_of(sums),
        "promo_matrix": lift.select("sku_id", F.col("mean_no_promo").alias("no_promo"), F.col("mean_promo").alias("promo")),
        "price_sample": eda.sample_per_sku(dated, dated.columns, copy=F.monotonically_increasing_id().cast("string")),
    }


def explore_variants(variants: dict[str, DataFrame], split_day: str) -> dict[str, DataFrame]:
    """One job for all variants: summary and the train and test sets."""
    stacked = eda.label_variants(variants)
    train, test = eda.split_by_date(stacked, split_day)
    return {"summary": eda.variant_summary(stacked), "train": train, "test": test}


def stationarity_report(rows: DataFrame, by: str | None = None, max_lag: int = 40) -> dict[str, DataFrame]:
    """Unit-root tests of level and difference, and the correlations of the chosen series."""
    ensure_checkpoint_dir(rows.sparkSession)
    dated = rows.filter("date is not null")
    dense = densify_calendar(daily_aggregate(with_series(dated, by))).select("series_id", "date", "total_units").checkpoint()
    change = first_difference(dense).select("series_id", "date", F.col("diff").cast("double").alias("value"))
    of_level, of_change = stationarity.adf_test(dense).checkpoint(), stationarity.adf_test(change, "value").checkpoint()
    choice = stationarity.choose_differencing(of_level, of_change)
    level = dense.select("series_id", "date", F.col("total_units").cast("double").alias("value"))
    use = choice.select("series_id", (F.col("use") == "level").alias("as_level"))
    both = level.withColumn("is_level", F.lit(True)).unionByName(change.withColumn("is_level", F.lit(False)))
    chosen = both.join(use, "series_id").filter(F.col("is_level") == F.col("as_level")).select(
        "series_id", "date", "value")
    return {
        "adf_level": of_level,
        "adf_difference": of_change,
        "choice": choice,
        "acf": stationarity.acf(chosen, "value", max_lag),
        "pacf": stationarity.pacf(chosen, "value", max_lag),
    }
