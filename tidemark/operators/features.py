"""Model inputs: windows, splits, future regressors and scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.calendar import calendar_features
from tidemark.operators.series import by_day
from tidemark.schema import N_IN, N_OUT, WINDOW_FEATURES


def feature_columns(target: str = "total_units") -> list[str]:
    """Target first, then the regressors."""
    return [target, *[c for c in WINDOW_FEATURES if c != target]]


def supervised_windows(daily: DataFrame, columns: list[str], n_in: int = N_IN, n_out: int = N_OUT) -> DataFrame:
    """Every complete pair of ``n_in`` past days (all columns) and ``n_out`` next targets.

    ``date`` is the first target day, ``x`` an array of day vectors, ``y`` the target values.
    """
    day = F.array(*[F.col(c).cast("double") for c in columns])
    past = by_day().rowsBetween(-n_in, -1)
    ahead = by_day().rowsBetween(0, n_out - 1)
    return daily.select(
        "series_id", "date",
        F.collect_list(day).over(past).alias("x"),
        F.collect_list(F.col(columns[0]).cast("double")).over(ahead).alias("y"),
    ).filter((F.size("x") == n_in) & (F.size("y") == n_out))


def input_windows(daily: DataFrame, columns: list[str], n_in: int = N_IN) -> DataFrame:
    """The ``n_in`` days before each day that has that many, for one-step prediction."""
    day = F.array(*[F.col(c).cast("double") for c in columns])
    return daily.select(
        "series_id", "date", F.collect_list(day).over(by_day().rowsBetween(-n_in, -1)).alias("x"),
    ).filter(F.size("x") == n_in)


def validation_split(windows: DataFrame, share: float = 0.1, least: int = 20) -> DataFrame:
    """Flag the last tenth (at least one) of the windows of each series as ``is_val``. A series with
    fewer than ``least`` windows has none to spare: all of them train."""
    whole = Window.partitionBy("series_id")
    n = F.count(F.lit(1)).over(whole)
    held = F.greatest(F.lit(1), (F.lit(share) * F.col("_n")).cast("bigint"))
    return (windows.withColumns({"_n": n, "_i": F.row_number().over(by_day())})
            .withColumn("is_val", (F.col("_n") >= least) & (F.col("_i") > F.col("_n") - held)).drop("_n", "_i"))


def last_rows(daily: DataFrame, n: int = N_IN) -> DataFrame:
    latest = Window.partitionBy("series_id").orderBy(F.desc("date"))
    return daily.withColumn("_r", F.row_number().over(latest)).filter(F.col("_r") <= n).drop("_r")


def seed_statistics(seed: DataFrame) -> DataFrame:
    """Per series: last day, price of that day, share of promotion days."""
    return seed.groupBy("series_id").agg(
        F.max("date").alias("last_date"),
        F.max_by("avg_price", "date").alias("last_price"),
        F.avg("promo_any").alias("promo_mean"),
        F.count(F.lit(1)).alias("n_seed"))


def future_features(stats: DataFrame, days: int | Column) -> DataFrame:
    """The next ``days`` days of each series with assumed price and promotion."""
    horizon = F.lit(days) if isinstance(days, int) else days
    future = stats.withColumn("date", F.explode(F.sequence(
        F.date_add("last_date", 1), F.date_add(F.col("last_date"), horizon))))
    return calendar_features(future.select(
        "series_id", "date", F.col("last_price").alias("avg_price"),
        (F.col("promo_mean") > 0.5).cast("int").alias("promo_any")))


def fit_standard(train: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation per series and column; a constant column divides by one."""
    return _fit(train, columns, {"shift": F.avg, "scale": F.stddev_pop})


def fit_minmax(train: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum and range per series and column; a constant column divides by one."""
    return _fit(train, columns, {"shift": F.min, "scale": lambda c: F.max(c) - F.min(c)})


def _fit(train: DataFrame, columns: list[str], rules: dict) -> DataFrame:
    out = []
    for c in columns:
        value = F.col(c).cast("double")
        scale = rules["scale"](value)
        out.append(F.struct(rules["shift"](value).alias("shift"),
                            F.when(scale > 0, scale).otherwise(1.0).alias("scale")).alias(c))
    return train.groupBy("series_id").agg(F.struct(*out).alias("scaler"))


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: list[str]) -> DataFrame:
    """Scale columns with the statistics of another frame; one scaler row per series."""
    joined = df.join(scaler, "series_id")
    return joined.withColumns({
        c: (F.col(c) - F.col(f"scaler.{c}.shift")) / F.col(f"scaler.{c}.scale") for c in columns
    }).drop("scaler")


def invert_scaler(value: Column, column: str) -> Column:
    """Back to the original unit; expects the ``scaler`` struct in the row."""
    return value * F.col(f"scaler.{column}.scale") + F.col(f"scaler.{column}.shift")
