"""Session helper for jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Filled in only where neither the submit configuration nor the caller says otherwise.
_SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# For a session in this process only.
_LOCAL = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        conf = {**_LOCAL, **conf}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    defaults = dict(_SQL_DEFAULTS)
    if spark.sparkContext.master.startswith("local"):
        defaults["spark.sql.shuffle.partitions"] = str(spark.sparkContext.defaultParallelism)
    given = spark.sparkContext.getConf()
    for key, value in defaults.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local session
    that names none gets a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder
