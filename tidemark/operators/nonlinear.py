"""Nonlinear model: boosted trees on pooled windows, one ensemble per day of the output block.

All series are trained together. They are forecast side by side inside one Arrow map: the fitted trees are flat arrays
there, and neither the driver nor a checkpoint takes part in the steps of the horizon.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.functions.shipping import ship_with_tasks
from tidemark.operators.features import (apply_scaler, feature_columns, fit_minmax, future_features, last_rows,
                                         seed_statistics, supervised_windows, validation_split)
from tidemark.operators.linear import TOGETHER, by_series, numbers, whole_series
from tidemark.operators.series import by_day
from tidemark.operators.trees import NODE_SCHEMA, follow_blocks, forests, nodes_of
from tidemark.schema import N_IN, N_OUT
from tidemark.sources.registry import save_table

ship_with_tasks(__name__)

WINDOWS = 4_096  # windows of a series that are spread out at once
FEW_WINDOWS = 10_000  # windows that one task trains on; the fit finds its thresholds on as many
FORECAST_SCHEMA = "series_id string, date date, predicted_units double"


@dataclass
class NonlinearModel:
    """``trees`` has a row per node (:mod:`tidemark.operators.trees`), ``scaler`` a row per series."""

    target: str
    trees: pd.DataFrame
    scaler: DataFrame
    n_in: int = N_IN

    @property
    def columns(self) -> list[str]:
        return feature_columns(self.target)

    def save(self, folder: str) -> None:
        save_table(self.scaler.sparkSession.createDataFrame(self.trees, NODE_SCHEMA), f"{folder}/trees")
        save_table(self.scaler, f"{folder}/scaler")

    @classmethod
    def load(cls, spark: SparkSession, folder: str, target: str) -> "NonlinearModel":
        # Nodes: at most output steps x rounds x 2^(depth + 1) rows.
        trees = spark.read.parquet(f"{folder}/trees").toPandas()
        return cls(target, trees, spark.read.parquet(f"{folder}/scaler"))


def as_vector(windows: DataFrame) -> DataFrame:
    return windows.withColumn("features", array_to_vector(F.flatten("x")))


def fit_nonlinear(daily: DataFrame, target: str = "total_units", n_in: int = N_IN, n_out: int = N_OUT,
                  rounds: int = 20, depth: int = 4, seed: int = 42, parallel: int = N_OUT) -> NonlinearModel:
    """Scale, cut windows, hold back the last tenth of each series for early stopping, fit.

    The output steps are independent Spark jobs, submitted ``parallel`` at a time.
    """
    columns = feature_columns(target)
    scaler = fit_minmax(daily, columns)
    scaled = apply_scaler(daily.select("series_id", "date", *columns), scaler, columns)
    windows = validation_split(supervised_windows(scaled, columns, n_in, n_out))
    data = as_vector(windows).select("features", "is_val", *[F.col("y")[k].alias(f"y{k}") for k in range(n_out)])
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if data.filter("is_val").isEmpty():
            raise ValueError("too few windows to train the nonlinear model")
        # Every round sends a result from every part to the driver, and most parts of a few windows are empty.
        data_of_fit = data.coalesce(1) if data.count() <= FEW_WINDOWS else data

        def fit(k: int) -> pd.DataFrame:
            trees = GBTRegressor(labelCol=f"y{k}", validationIndicatorCol="is_val", maxIter=rounds, maxDepth=depth, seed=seed)
            return nodes_of(trees.fit(data_of_fit).toDebugString, k)

        with ThreadPoolExecutor(parallel) as pool:
            steps = list(pool.map(inheritable_thread_target(daily.sparkSession)(fit), range(n_out)))
    finally:
        data.unpersist()
    return NonlinearModel(target, pd.concat(steps, ignore_index=True), scaler, n_in)


def _scaled(model: NonlinearModel, rows: DataFrame, columns: list[str], ahead: bool) -> DataFrame:
    """Scaled columns, as many as the model has, next to what brings the target back to its unit."""
    of_target = [F.col(f"scaler.{model.target}.{part}").alias(part) for part in ("shift", "scale")]
    scaled = [((F.col(c).cast("double") - F.col(f"scaler.{c}.shift")) / F.col(f"scaler.{c}.scale")
               if c in columns else F.lit(None).cast("double")).alias(f"c{k}") for k, c in enumerate(model.columns)]
    return rows.select("series_id", "date", *columns).join(model.scaler, "series_id").select(
        "series_id", "date", F.lit(ahead).alias("ahead"), *of_target, *scaled)


def _forecast_rows(name: str, dates, values: np.ndarray, rows: pa.Table) -> pa.RecordBatch:
    shift, scale = (numbers(rows, c)[0] for c in ("shift", "scale"))
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * len(values), pa.string()), dates.combine_chunks(), pa.array(values * scale + shift, from_pandas=True)],
        names=["series_id", "date", "predicted_units"])


def predict_one_step(model: NonlinearModel, daily: DataFrame) -> DataFrame:
    """For every day with a full window before it, the next-day prediction in original units."""
    n_in, names = model.n_in, [f"c{k}" for k in range(len(model.columns))]
    nodes = model.trees[model.trees["step"] == 0]

    def run(batches):
        step = forests(nodes)[0]
        for name, rows in whole_series(batches):
            days = np.column_stack([numbers(rows, c) for c in names])
            windows = np.lib.stride_tricks.sliding_window_view(days, n_in, axis=0)[:-1] if len(days) > n_in else ()
            for first in range(0, len(windows), WINDOWS):
                part = windows[first:first + WINDOWS]
                values = step(part.transpose(0, 2, 1).reshape(len(part), -1))
                yield _forecast_rows(name, rows.column("date").slice(n_in + first, len(part)), values, rows)

    scaled = _scaled(model, daily, model.columns, False)
    return by_series(scaled, "date").mapInArrow(run, FORECAST_SCHEMA)


def roll_forward(model: NonlinearModel, seed: DataFrame, future: DataFrame, days: int | None = None,
                 block: int | None = None) -> DataFrame:
    """Forecast block by block, each predicted target entering the next window.

    ``seed`` holds the last days of each series, ``future`` the regressors of the coming ones, of which the first ``days``
    are forecast (all by default). Seed and coming days of a series meet in one task, which steps through the horizon
    of many series side by side; a series is as long as its horizon.
    """
    n_in, names = model.n_in, [f"c{k}" for k in range(len(model.columns))]
    nodes = model.trees

    def run(batches):
        steps = forests(nodes)
        length = block or len(steps)
        held, size = [], 0

        def followed():
            longest = max(len(coming) for _, _, _, coming in held)
            # A shorter horizon is filled up; days that are filled come behind all that count.
            coming = np.stack([np.pad(c, ((0, longest - len(c)), (0, 0)), mode="edge") for _, _, _, c in held])
            values = follow_blocks(np.stack([h[2] for h in held]), coming, steps, length)
            for (name, rows, _, coming), row in zip(held, values):
                yield _forecast_rows(name, rows.column("date").slice(n_in, len(coming)), row[:len(coming)], rows)

        for name, rows in whole_series(batches):
            known = int((~rows.column("ahead").to_numpy()).sum())
            if known != n_in or rows.num_rows == known:
                continue
            if days is not None:
                rows = rows.slice(0, n_in + days)
            x = np.column_stack([numbers(rows, c) for c in names])
            held.append((name, rows, x[:n_in], x[n_in:, 1:]))
            size += len(x)
            if len(held) >= TOGETHER or size >= WINDOWS * TOGETHER:
                yield from followed()
                held.clear()
                size = 0
        if held:
            yield from followed()

    rows = _scaled(model, seed, model.columns, False).unionByName(_scaled(model, future, model.columns[1:], True))
    followed = by_series(rows, "ahead", "date").mapInArrow(run, FORECAST_SCHEMA)
    return followed.unionByName(without_window(model, seed, future, days))


def without_window(model: NonlinearModel, seed: DataFrame, future: DataFrame, days: int | None = None) -> DataFrame:
    """Forecast of the series that the trees cannot follow: fewer days than a window, or unknown to
    the scaler. Their residual is taken to be zero, their units to be the mean of the days they have."""
    known = seed.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.avg(model.target).alias("mean"))
    scaled = model.scaler.select("series_id", F.lit(True).alias("scaled"))
    left = known.join(scaled, "series_id", "left").filter((F.col("n") < model.n_in) | F.col("scaled").isNull())
    value = F.lit(0.0) if model.target == "residuals" else F.col("mean").cast("double")
    ahead = future.select("series_id", "date")
    if days is not None:
        ahead = ahead.withColumn("_i", F.row_number().over(by_day())).filter(F.col("_i") <= days)
    return ahead.join(left, "series_id").select("series_id", "date", value.alias("predicted_units"))


def forecast_blocks(model: NonlinearModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """Forecast the days of ``test`` from the end of ``train`` with the regressors of ``test``."""
    return roll_forward(model, last_rows(train, model.n_in), test)


def forecast_future(model: NonlinearModel, history: DataFrame, days: int, block: int | None = None) -> DataFrame:
    """Forecast past the end of history with assumed regressors."""
    seed = last_rows(history, model.n_in)
    return roll_forward(model, seed, future_features(seed_statistics(seed), days), days, block)
