"""Forecast of the coming quarters from a sales file and stored models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.align import KEY, hybrid_sum, residuals
from tidemark.operators.horizon import allocate, bridge_gap, plan_horizon, sku_shares
from tidemark.operators.linear import run_model
from tidemark.operators.nonlinear import NonlinearModel, forecast_future
from tidemark.operators.report import (centred_averages, downsample, quarterly_rollup, rounded_forecast, summary_stats,
                                       total_with_averages)
from tidemark.plans.ingest import clean_sales, ingest, raw_history
from tidemark.schema import ALL_SERIES
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.registry import current_version
from tidemark.sources.sales import read_sales


@dataclass
class Forecast:
    """Flat tables of one forecast. ``*_points`` are thinned for charts."""

    sku_daily: DataFrame
    sku_quarterly: DataFrame
    total_daily: DataFrame
    sku_points: DataFrame
    total_points: DataFrame
    summary: DataFrame


def forecast_total(history: DataFrame, folder: str, quarters: int, as_of: str, legacy_shift: bool = False) -> DataFrame:
    """Daily hybrid forecast of every series of ``history`` (the total, or one per product).

    All series are bridged to the same day. A series without stored models follows its mean. Skipped days are forecast and dropped, so that a value belongs to the day it is labelled
    with. ``legacy_shift`` labels the first forecast day with the first day of the next month.
    """
    spark = history.sparkSession
    folder = current_version(spark, folder)
    ensure_checkpoint_dir(spark)
    history = history.checkpoint()
    ends = history.agg(F.max("date").alias("last_date"))
    plan = plan_horizon(ends, as_of, quarters).first()  # one row: the calendar of the forecast
    known = bridge_gap(history, F.date_add(F.lit(plan["bridged_to"]), 1)).checkpoint()
    steps, skip = plan["total_days"], plan["days_to_skip"]

    future = known.groupBy("series_id").agg(F.max("date").alias("hi")).select(
        "series_id", F.explode(F.sequence(F.date_add("hi", 1), F.date_add("hi", steps))).alias("date"))
    run = run_model(known, spark.read.parquet(f"{folder}/linear"), future).checkpoint()
    fitted = run.filter("not is_future").select(*KEY, "fitted")
    linear = run.filter("is_future").select(*KEY, F.col("fitted").alias("predicted_units"))
    model = NonlinearModel.load(spark, f"{folder}/nonlinear", "residuals")
    total = hybrid_sum(linear, forecast_future(model, residuals(known, fitted), steps))
    if legacy_shift:
        last = F.lit(plan["bridged_to"])
        return total.filter(F.date_diff("date", last) <= plan["forecast_days"]).withColumn(
            "date", F.date_add("date", skip)).checkpoint()
    return total.filter(F.col("date") >= F.lit(plan["first_label"])).checkpoint()


def report_forecast(total: DataFrame, rows: DataFrame, quarters: int) -> Forecast:
    """Allocate a total forecast to the products of ``rows`` and build all reported tables. The
    shares (one row per product) are stored once for all of them."""
    return _reports(total, allocate(total, sku_shares(rows).checkpoint()), quarters)


def report_products(forecasts: DataFrame, quarters: int) -> Forecast:
    """All reported tables of forecasts made per product; the total is their sum."""
    total = forecasts.groupBy("date").agg(F.sum("predicted_units").alias("predicted_units")).select(
        F.lit(ALL_SERIES).alias("series_id"), "date", "predicted_units")
    return _reports(total, forecasts.withColumnRenamed("series_id", "sku_id"), quarters)


def _reports(total: DataFrame, per_sku: DataFrame, quarters: int) -> Forecast:
    days = total.count()  # one row per day of the horizon
    per_sku = centred_averages(per_sku)
    sku_daily = rounded_forecast(per_sku)
    total_daily = total_with_averages(total)
    thinned = downsample(total_daily.withColumnRenamed("series_id", "sku_id"))
    return Forecast(sku_daily, quarterly_rollup(per_sku), total_daily, downsample(sku_daily), thinned,
                    summary_stats(sku_daily, quarters, days))


def run_forecast(spark: SparkSession, path: str, quarters: int, as_of: str, folder: str, clean: bool = False,
                 legacy_shift: bool = False, by: str | None = None) -> Forecast:
    """``as_of`` is the day the forecast is made. Product shares come from the rows as uploaded
    unless ``clean`` asks for the cleaned ones. With ``by`` (and models trained with it) every series
    has its own forecast, and nothing is allocated."""
    return forecast_rows(read_sales(spark, path), quarters, as_of, folder, clean, legacy_shift, by)


def forecast_rows(raw: DataFrame, quarters: int, as_of: str, folder: str, clean: bool = False,
                  legacy_shift: bool = False, by: str | None = None) -> Forecast:
    forecasts = forecast_total(ingest(raw, by=by), folder, quarters, as_of, legacy_shift)
    if by is not None:
        return report_products(forecasts, quarters)
    return report_forecast(forecasts, clean_sales(raw) if clean else raw_history(raw), quarters)
