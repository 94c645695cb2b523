"""Run registry and stored models. All state is Parquet."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def record_run(metrics: DataFrame, run_id: str, ts: str, seed: int, train_size: int, test_size: int,
               folder: str) -> DataFrame:
    """Append one run; ``metrics`` has a row per model with ``rmse`` and ``mape``."""
    run = run_record(metrics, run_id, ts, seed, train_size, test_size)
    run.write.mode("append").partitionBy("run_id").parquet(folder)
    return run


def run_record(metrics: DataFrame, run_id: str, ts: str, seed: int, train_size: int,
               test_size: int) -> DataFrame:
    """One row per run, the metrics of its models as a map."""
    pairs = metrics.select(F.explode(F.array(
        F.struct(F.concat("model", F.lit("_rmse")).alias("k"), F.col("rmse").alias("v")),
        F.struct(F.concat("model", F.lit("_mape")).alias("k"), F.col("mape").alias("v")))).alias("p"))
    # A handful of models per run, so the map is small.
    return pairs.agg(F.map_from_entries(F.collect_list("p")).alias("metrics")).select(
        F.lit(run_id).alias("run_id"), F.lit(ts).cast("timestamp").alias("ts"),
        F.lit(seed).alias("seed"), F.lit(train_size).alias("train_size"),
        F.lit(test_size).alias("test_size"), "metrics")


def latest_run(runs: DataFrame) -> DataFrame:
    """The most recent run as one row; ties go to the larger run id."""
    row = F.struct(*[F.col(c) for c in runs.columns])
    return runs.agg(F.max_by(row, F.struct("ts", "run_id")).alias("r")).select("r.*")


def latest_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return latest_run(spark.read.parquet(folder))


def save_table(df: DataFrame, folder: str) -> DataFrame:
    """Write and read back: stores fitted coefficients or scalers and cuts the lineage."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def new_version(folder: str) -> str:
    """A folder of its own below ``folder`` for a set of models. Readers do not see it before :func:`commit_version`."""
    return f"{folder}/versions/{uuid.uuid4().hex}"


def commit_version(spark: SparkSession, version: str) -> None:
    """Make a complete version the current one, by one row in the manifest. A job that dies before this leaves the last
    version in force; versions stay until the owner of the folder deletes them."""
    folder, name = version.rsplit("/versions/", 1)
    row = spark.range(1).select(F.lit(name).alias("version"), F.current_timestamp().alias("committed_at"))
    row.coalesce(1).write.mode("append").parquet(f"{folder}/manifest")


def current_version(spark: SparkSession, folder: str) -> str:
    """Folder of the version committed last. A folder without a manifest holds its models itself."""
    try:
        manifest = spark.read.parquet(f"{folder}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return folder
    last = manifest.agg(F.max_by("version", F.struct("committed_at", "version")).alias("v")).first()["v"]
    return folder if last is None else f"{folder}/versions/{last}"
