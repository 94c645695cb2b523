"""Training: linear model, trees on its residuals, their sum, and trees alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.rounding import units_from_forecast
from tidemark.operators.align import KEY, align, hybrid_sum, require_regressors, residuals
from tidemark.operators.evaluate import long_scores, model_metrics
from tidemark.operators.features import apply_scaler, fit_standard
from tidemark.operators.linear import (Grid, apply_linear, coefficient_table, forecast_linear, run_model,
                                       search_orders)
from tidemark.operators.nonlinear import NonlinearModel, fit_nonlinear, forecast_blocks, predict_one_step
from tidemark.operators.series import MIN_TRAIN, short_series, validate_length
from tidemark.plans.ingest import ingest, load_series
from tidemark.schema import LINEAR_REGRESSORS
from tidemark.sources.registry import commit_version, current_version, new_version, record_run, save_table

MODELS = ["hybrid", "linear_only", "nonlinear_only"]


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    rounds: int = 20
    depth: int = 4
    grid: Grid = Grid()


def longest(daily: DataFrame) -> int:
    """Days of the longest series: one number for the run record."""
    return daily.groupBy("series_id").count().agg(F.max("count")).first()[0]


def train_hybrid(train: DataFrame, test: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Fit all models on daily series, store them under ``folder`` and return the test forecasts,
    one column per model next to the actual units.

    Series that are too short for a good model are kept and listed in the table ``short_series``; a single
    series, or a catalog without any series that is long enough, is refused.
    """
    train = save_table(train, f"{folder}/series/train")
    test = save_table(test, f"{folder}/series/test")
    validate_length(train, test)
    save_table(short_series(train, MIN_TRAIN), f"{folder}/short_series")

    coefficients = save_table(search_orders(train, grid=settings.grid), f"{folder}/linear")
    run = save_table(run_model(train, coefficients, test.select(*KEY)), f"{folder}/series/linear_run")
    fitted = run.filter("not is_future").select(*KEY, "fitted")
    linear = run.filter("is_future").select(*KEY, F.col("fitted").alias("predicted_units"))

    known = residuals(train, fitted)
    on_residuals = fit_nonlinear(known, "residuals", rounds=settings.rounds, depth=settings.depth, seed=settings.seed)
    on_residuals.save(f"{folder}/nonlinear")
    residual = forecast_blocks(on_residuals, known, test)

    alone = fit_nonlinear(train, "total_units", rounds=settings.rounds, depth=settings.depth, seed=settings.seed)
    units = forecast_blocks(alone, train, test)

    def named(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(*KEY, F.col("predicted_units").alias(name))

    forecasts = named(hybrid_sum(linear, residual), "hybrid").join(named(linear, "linear_only"), KEY) \
        .join(named(units, "nonlinear_only"), KEY)
    return save_table(align(test.select(*KEY, "total_units"), forecasts), f"{folder}/series/forecasts")


def train(spark: SparkSession, train_path: str, test_path: str, folder: str, run_id: str, ts: str,
          settings: Settings = Settings(), by: str | None = None) -> DataFrame:
    """Train on two sales files, record the run and return its metrics per model. The metrics of
    each series are stored as the table ``series/metrics``.

    All models of a run lie in one version below ``folder``, which is committed when it is complete."""
    train_rows, test_rows = load_series(spark, train_path, by=by), load_series(spark, test_path, by=by)
    version = new_version(folder)
    forecasts = train_hybrid(train_rows, test_rows, version, settings)
    scored = long_scores(forecasts, MODELS)
    metrics = model_metrics(scored)
    save_table(model_metrics(scored, ("series_id", "model")), f"{version}/series/metrics")
    sizes = [longest(spark.read.parquet(f"{version}/series/{part}")) for part in ("train", "test")]
    commit_version(spark, version)
    record_run(metrics, run_id, ts, settings.seed, *sizes, f"{folder}/runs")
    return metrics.withColumn("run_id", F.lit(run_id)).select("run_id", "model", "rmse", "mape")


def train_with_regressors(train: DataFrame, test: DataFrame, regressors: list[str] = LINEAR_REGRESSORS,
                          grid: Grid = Grid(), folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Linear model with scaled regressors: coefficients and the forecast of the test days. With a
    ``folder`` coefficients and scaler are stored there, for :func:`forecast_with_regressors`."""
    if folder is None:
        return _fit_regressors(train, test, regressors, grid, None)
    version = new_version(folder)
    fitted = _fit_regressors(train, test, regressors, grid, version)
    commit_version(train.sparkSession, version)
    return fitted


def _fit_regressors(train: DataFrame, test: DataFrame, regressors: list[str], grid: Grid,
                    folder: str | None) -> tuple[DataFrame, DataFrame]:
    require_regressors(test.select(*KEY), test.dropna(subset=regressors).select(*KEY))
    scaler = fit_standard(train, regressors)
    coefficients = search_orders(apply_scaler(train, scaler, regressors), exog=tuple(regressors), grid=grid)
    if folder is not None:
        scaler = save_table(scaler, f"{folder}/scaler")
        coefficients = save_table(coefficients, f"{folder}/linear")
    return coefficients, _with_regressors(train, test, coefficients, scaler, regressors)


def forecast_with_regressors(history: DataFrame, future: DataFrame, folder: str,
                             regressors: list[str] = LINEAR_REGRESSORS) -> DataFrame:
    """Forecast the days of ``future`` with stored coefficients and their stored scaler."""
    spark = history.sparkSession
    folder = current_version(spark, folder)
    return _with_regressors(history, future, spark.read.parquet(f"{folder}/linear"),
                            spark.read.parquet(f"{folder}/scaler"), regressors)


def _with_regressors(history: DataFrame, future: DataFrame, coefficients: DataFrame, scaler: DataFrame,
                     regressors: list[str]) -> DataFrame:
    scaled = [apply_scaler(days, scaler, regressors) for days in (history, future)]
    return forecast_linear(scaled[0], coefficients, scaled[1], exog=tuple(regressors))


def compare_models(train: DataFrame, test: DataFrame, folder: str, settings: Settings = Settings(),
                   store_models: bool = True) -> tuple[DataFrame, DataFrame]:
    """The linear model with regressors against the nonlinear model alone on the test days: metrics
    per model, and the summary table of the linear coefficients. Models and series lie in one version of ``folder``."""
    folder = new_version(folder)
    train = save_table(train, f"{folder}/series/train")
    test = save_table(test, f"{folder}/series/test")
    validate_length(train, test)
    coefficients, linear = _fit_regressors(train, test, LINEAR_REGRESSORS, settings.grid, folder)
    linear = save_table(linear, f"{folder}/series/linear_forecast")
    alone = fit_nonlinear(train, "total_units", rounds=settings.rounds, depth=settings.depth, seed=settings.seed)
    if store_models:
        alone.save(f"{folder}/nonlinear")
    units = forecast_blocks(alone, train, test)
    forecasts = linear.select(*KEY, F.col("predicted_units").alias("linear_regressors")).join(
        units.select(*KEY, F.col("predicted_units").alias("nonlinear_only")), KEY)
    forecasts = save_table(align(test.select(*KEY, "total_units"), forecasts), f"{folder}/series/forecasts")
    commit_version(train.sparkSession, folder)
    metrics = model_metrics(long_scores(forecasts, ["linear_regressors", "nonlinear_only"]))
    scaled = apply_scaler(train, train.sparkSession.read.parquet(f"{folder}/scaler"), LINEAR_REGRESSORS)
    return metrics, coefficient_table(scaled, coefficients, exog=tuple(LINEAR_REGRESSORS), grid=settings.grid)


def backtest_one_step(raw: DataFrame, folder: str, by: str | None = None) -> DataFrame:
    """Stored models on a new file: whole predicted units for every day after the first window."""
    spark = raw.sparkSession
    folder = current_version(spark, folder)
    daily = ingest(raw, by=by)
    fitted = apply_linear(daily, spark.read.parquet(f"{folder}/linear"))
    known = residuals(daily, fitted)
    model = NonlinearModel.load(spark, f"{folder}/nonlinear", "residuals")
    parts = hybrid_sum(fitted.withColumnRenamed("fitted", "predicted_units"), predict_one_step(model, known),
                       only_both=True)
    return parts.withColumn("predicted_units", units_from_forecast("predicted_units"))
