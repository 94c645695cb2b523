"""Reported views of daily demand and forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.functions.rounding import half_even
from tidemark.operators.series import by_day


def by_sku() -> WindowSpec:
    return Window.partitionBy("sku_id").orderBy("date")


def _mean(value: str | Column, first: int, last: int, over: WindowSpec | None = None) -> Column:
    return F.avg(value).over((over or by_sku()).rowsBetween(first, last))


def recent_window(df: DataFrame, days: int = 28) -> DataFrame:
    """Rows of the last ``days`` days, the maximum day included."""
    return df.filter(F.col("date") > df.agg(F.date_sub(F.max("date"), days).alias("cut")).scalar())


def zoom_window(df: DataFrame, days: int = 180) -> DataFrame:
    """Rows from ``days`` before the last day, but not before the first."""
    start = df.agg(F.greatest(F.min("date"), F.date_sub(F.max("date"), days)).alias("start")).scalar()
    return df.filter(F.col("date") >= start)


def centred_averages(forecast: DataFrame) -> DataFrame:
    """Per product: centred 7-row mean, and the 14-row mean of seven rows before to six after."""
    return forecast.withColumns({"ma7": _mean("predicted_units", -3, 3),
                                 "ma14": _mean("predicted_units", -7, 6)})


def centred_smooth(series: DataFrame, name: str, out: str = "smooth") -> DataFrame:
    return series.withColumn(out, _mean(name, -3, 3, by_day()))


def rounded_forecast(daily: DataFrame) -> DataFrame:
    """Output rounding of a product forecast, after its averages."""
    return daily.withColumns({
        "predicted_units": half_even("predicted_units").cast("bigint"),
        "ma7": half_even("ma7", 1), "ma14": half_even("ma14", 1)})


def total_with_averages(total: DataFrame) -> DataFrame:
    """The total is rounded first, its averages look back only."""
    whole = total.withColumn("predicted_units", half_even("predicted_units").cast("bigint"))
    return whole.withColumns({
        "ma7": half_even(_mean("predicted_units", -6, 0, by_day()), 1),
        "ma14": half_even(_mean("predicted_units", -13, 0, by_day()), 1)})


def trailing_average(rows: DataFrame, days: int = 14) -> DataFrame:
    """Per product trailing mean of daily units; rows are first summed to one per day."""
    daily = rows.groupBy("sku_id", "date").agg(F.sum("units_sold").alias("units"))
    return daily.withColumn(f"ma{days}", _mean("units", -(days - 1), 0))


def quarterly_rollup(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("sku_id", F.year("date").alias("year"), F.quarter("date").alias("quarter")).agg(
        half_even(F.sum("predicted_units")).cast("bigint").alias("predicted_units"),
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
    ).select("sku_id", F.concat(F.lit("Q"), "quarter", F.lit(" "), "year").alias("quarter_label"),
             "predicted_units", "start_date", "end_date")


def monthly_rollup(forecast: DataFrame) -> DataFrame:
    return (forecast.groupBy("sku_id", F.date_format("date", "yyyy-MM").alias("month"))
            .agg(F.sum("predicted_units").alias("predicted_units")))


def weekday_means(forecast: DataFrame) -> DataFrame:
    """Mean forecast per weekday; a weekday without data reports zero."""
    day = F.weekday("date")
    means = F.array(*[F.coalesce(F.avg(F.when(day == i, F.col("predicted_units"))), F.lit(0.0))
                      for i in range(7)])
    return (forecast.groupBy("sku_id").agg(means.alias("means"))
            .select("sku_id", F.posexplode("means").alias("weekday", "mean_units")))


def histogram(forecast: DataFrame, bins: int = 15) -> DataFrame:
    """Equal-width bins between the extremes of each product, empty ones kept, the last closed.

    The days are streamed twice, once for the extremes and once for the counts: neither sorts them, and a task
    holds one row per product. Rows without a product are one group, whose extremes a join would not find.
    """
    value = F.col("predicted_units").cast("double")
    ends = F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))
    nameless = forecast.filter("sku_id is null").agg(ends.alias("e")).scalar()
    known = forecast.groupBy("sku_id").agg(ends.alias("e"))
    joined = forecast.join(known.hint("shuffle_hash"), "sku_id", "left").withColumn(
        "e", F.when(F.col("sku_id").isNull(), nameless).otherwise(F.col("e")))
    spread = (F.col("e.hi") - F.col("e.lo")) / bins
    ranged = joined.select("sku_id", value.alias("v"), F.col("e.lo").alias("lo"),
                           F.when(spread > 0, spread).otherwise(1.0).alias("w"))
    slot = F.least(F.floor((F.col("v") - F.col("lo")) / F.col("w")), F.lit(bins - 1))
    counts = ranged.withColumn("slot", slot).groupBy("sku_id").agg(
        F.first("lo").alias("lo"), F.first("w").alias("w"),
        F.array(*[F.count_if(F.col("slot") == i) for i in range(bins)]).alias("counts"))
    long = counts.select("sku_id", "lo", "w", F.posexplode("counts").alias("bin", "n"))
    lower = F.col("lo") + F.col("bin") * F.col("w")

    def whole_number(c: Column) -> Column:
        return F.floor(c + 0.5).cast("string")

    return long.select("sku_id", "bin", F.concat(whole_number(lower), F.lit("-"),
                                                 whole_number(lower + F.col("w"))).alias("label"), "n")


def summary_stats(forecast: DataFrame, quarters: int, days: int) -> DataFrame:
    """Number of products, mean daily demand over all products and the horizon in words."""
    per_day = forecast.groupBy("date").agg(F.sum("predicted_units").alias("units"))
    skus = forecast.select("sku_id").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return per_day.agg(F.avg("units").alias("mean_daily_units")).select(
        skus.alias("skus"), "mean_daily_units",
        F.lit(f"{quarters} quarters ({days} days)").alias("horizon"))


def downsample(daily: DataFrame, max_points: int = 500) -> DataFrame:
    """At most ``max_points`` rows per product, peaks kept. A row that is alone in its bucket (all rows of
    a product with few enough) comes back unchanged; averages over several are rounded.

    Row ``i`` belongs to the bucket whose floating-point edges enclose it, found by looking at
    the three candidates around ``i / step``; a row outside all buckets is dropped, as the
    edges demand.
    """
    whole = Window.partitionBy("sku_id")
    rows = daily.withColumns({"n": F.count(F.lit(1)).over(whole),
                              "i": F.row_number().over(by_sku()) - 1})
    step = F.col("n") / F.lit(float(max_points))

    def edge(b: Column) -> Column:
        return (b * step).cast("bigint")

    guess = F.floor(F.col("i") / step)
    bucket = F.coalesce(*[
        F.when((b >= 0) & (b < max_points) & (edge(b) <= F.col("i")) & (F.col("i") < edge(b + 1)), b)
        for b in (guess - 1, guess, guess + 1)])
    few = F.col("n") <= max_points
    placed = rows.withColumn("b", F.when(few, F.col("i").cast("bigint")).otherwise(bucket)).filter("b is not null")
    start, end = edge(F.col("b")), F.least(edge(F.col("b") + 1), F.col("n"))
    middle = F.when(few, F.col("i")).otherwise(start + F.floor((end - start) / 2))
    return placed.withColumn("mid", middle).groupBy("sku_id", "b").agg(
        F.max(F.when(F.col("i") == F.col("mid"), F.col("date"))).alias("date"),
        F.max("predicted_units").alias("predicted_units"), *[
            F.when(F.count(F.lit(1)) == 1, F.max(c)).otherwise(half_even(F.avg(c), 1)).alias(c)
            for c in ("ma7", "ma14")]).drop("b")


def comparison_matrix(daily: DataFrame, skus: list[str] | None = None) -> DataFrame:
    """Dates by products (the given ones, or all): the 14-day mean, or the units where it is missing."""
    return daily.groupBy("date").pivot("sku_id", skus).agg(
        F.first(F.coalesce("ma14", "predicted_units")))
