"""Forecast accuracy. ``scored`` has one row per model, series and day with ``actual`` and
``predicted``; ``metrics`` has one row per model (and run)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

EPS = 1e-8


def rmse() -> Column:
    error = F.col("actual") - F.col("predicted")
    return F.sqrt(F.avg(error * error)).alias("rmse")


def mape() -> Column:
    error = F.col("actual") - F.col("predicted")
    return (F.avg(F.abs(error) / (F.abs("actual") + EPS)) * 100).alias("mape")


def model_metrics(scored: DataFrame, keys: tuple[str, ...] = ("model",)) -> DataFrame:
    return scored.groupBy(*keys).agg(rmse(), mape())


def long_scores(aligned: DataFrame, models: list[str], actual: str = "total_units") -> DataFrame:
    """One column per model to one row per model."""
    return aligned.withColumnRenamed(actual, "actual").unpivot(
        ["series_id", "date", "actual"], models, "model", "predicted")


def relative_scores(metrics: DataFrame, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Best value over own value in percent; one row per model, so few rows per run."""
    run = Window.partitionBy(*keys)
    return metrics.select(*keys, "model", *[
        F.bround(F.min(c).over(run) / F.col(c) * 100, 2).alias(f"{c}_score") for c in ("rmse", "mape")])


def error_bars(metrics: DataFrame, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Length of each bar against the worst model, and its band."""
    run = Window.partitionBy(*keys)
    out = metrics
    for c in ("rmse", "mape"):
        worst = F.max(c).over(run)
        length = F.when(worst > 0, F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col(c) / worst * 100))) \
            .otherwise(0.0)
        out = out.withColumn(f"{c}_bar", length)
        out = out.withColumn(f"{c}_band", F.when(F.col(f"{c}_bar") >= 75, "high")
                             .when(F.col(f"{c}_bar") >= 50, "middle").otherwise("low"))
    return out


def leaderboard(metrics: DataFrame, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Models in ascending error with their rank."""
    order = Window.partitionBy(*keys).orderBy("rmse", "model")
    return metrics.withColumn("rank", F.row_number().over(order))


def best_of(metrics: DataFrame, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    return metrics.groupBy(*keys).agg(
        F.min_by("model", F.struct("rmse", "model")).alias("best_model"),
        F.min("rmse").alias("lowest_rmse"), F.min("mape").alias("lowest_mape"))


def compare_runs(metrics: DataFrame, runs: list[str]) -> DataFrame:
    """Metrics of several runs side by side, and the change of each against the first."""
    wide = metrics.filter(F.col("run_id").isin(runs)).groupBy("model").pivot("run_id", runs).agg(
        F.first("rmse").alias("rmse"), F.first("mape").alias("mape"))

    def pick(run: str, c: str) -> Column:
        return F.col(f"`{run}_{c}`")

    values = [pick(run, c).alias(f"{c}_{run}") for c in ("rmse", "mape") for run in runs]
    changes = [(pick(run, c) - pick(runs[0], c)).alias(f"delta_{c}_{run}") for c in ("rmse", "mape") for run in runs[1:]]
    return wide.select("model", *values, *changes)
