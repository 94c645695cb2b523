"""Exploratory summaries of canonical sales rows. All are single aggregations, combined on
the map side, so a product that owns a third of the table costs no more than any other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.rounding import half_even

WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def per_sku_summary(df: DataFrame, keys: tuple[str, ...] = ("sku_id",)) -> DataFrame:
    return df.groupBy(*keys).agg(
        half_even(F.avg("units_sold"), 3).alias("mean_units"),
        half_even(F.stddev_samp("units_sold"), 3).alias("std_units"),
        half_even(F.avg("price"), 3).alias("mean_price"),
        half_even(F.avg("promotion_flag"), 3).alias("promo_frac"))


def promo_lift(df: DataFrame, keys: tuple[str, ...] = ("sku_id",)) -> DataFrame:
    """Mean units with and without promotion and the relative lift."""
    return _lift(df.groupBy(*keys).agg(
        F.avg(F.when(F.col("promotion_flag") == 0, F.col("units_sold"))).alias("mean_no_promo"),
        F.avg(F.when(F.col("promotion_flag") == 1, F.col("units_sold"))).alias("mean_promo")))


def _lift(means: DataFrame) -> DataFrame:
    lift = (F.col("mean_promo") - F.col("mean_no_promo")) / F.nullif(F.col("mean_no_promo"), F.lit(0.0))
    return means.withColumn("relative_lift", lift)


def promo_summary(df: DataFrame, keys: tuple[str, ...] = ("sku_id",)) -> DataFrame:
    return rounded_lift(promo_lift(df, keys))


def rounded_lift(lift: DataFrame) -> DataFrame:
    return lift.withColumns({c: half_even(F.col(c), 3) for c in ("mean_no_promo", "mean_promo", "relative_lift")})


def weekday_profile(df: DataFrame) -> DataFrame:
    """Mean units by product and weekday (Monday = 0), long form."""
    return df.groupBy("sku_id", F.weekday("date").alias("weekday")).agg(
        F.avg("units_sold").alias("mean_units"))


def day_partials(df: DataFrame) -> DataFrame:
    """Sums per product, day and promotion flag, from which every mean of the exploration follows."""
    units, price = F.col("units_sold").cast("double"), F.col("price").cast("double")
    return df.groupBy("sku_id", "date", "promotion_flag").agg(
        F.count(F.lit(1)).alias("rows"), F.count("units_sold").alias("n_units"), F.sum(units).alias("units_sold"),
        F.sum(units * units).alias("squares"), F.count("price").alias("n_price"), F.sum(price).alias("price"))


def _mean_units(where=None) -> Column:
    wanted = F.lit(True) if where is None else where
    return F.try_divide(F.sum(F.when(wanted, F.col("units_sold"))), F.sum(F.when(wanted, F.col("n_units"))))


def per_sku_summary_of(partials: DataFrame) -> DataFrame:
    """:func:`per_sku_summary` from the sums of :func:`day_partials`."""
    n, units = F.sum("n_units"), F.sum("units_sold")
    flagged = F.col("promotion_flag").isNotNull()
    return partials.groupBy("sku_id").agg(
        half_even(_mean_units(), 3).alias("mean_units"),
        half_even(F.when(n > 1, F.sqrt(F.greatest((F.sum("squares") - units * units / n) / (n - 1), F.lit(0.0)))), 3).alias("std_units"),
        half_even(F.try_divide(F.sum("price"), F.sum("n_price")), 3).alias("mean_price"),
        half_even(F.try_divide(F.sum(F.col("promotion_flag") * F.col("rows")), F.sum(F.when(flagged, F.col("rows")))), 3).alias("promo_frac"))


def promo_lift_of(partials: DataFrame) -> DataFrame:
    """:func:`promo_lift` from the sums of :func:`day_partials`."""
    return _lift(partials.groupBy("sku_id").agg(_mean_units(F.col("promotion_flag") == 0).alias("mean_no_promo"),
                                                _mean_units(F.col("promotion_flag") == 1).alias("mean_promo")))


def weekday_profile_of(partials: DataFrame) -> DataFrame:
    """:func:`weekday_profile` from the sums of :func:`day_partials`."""
    return partials.groupBy("sku_id", F.weekday("date").alias("weekday")).agg(_mean_units().alias("mean_units"))


def weekday_matrix(df: DataFrame, skus: list[str] | None = None) -> DataFrame:
    """The profile with one column per product and labelled days: the given products, or all (Spark
    refuses a table that would need more than ``spark.sql.pivotMaxValues`` columns)."""
    labels = F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("weekday") + 1)
    wide = (df.withColumn("weekday", F.weekday("date")).groupBy("weekday")
            .pivot("sku_id", skus).agg(F.avg("units_sold")))
    return wide.withColumn("day", labels)


def promo_matrix(df: DataFrame) -> DataFrame:
    wide = df.groupBy("sku_id").pivot("promotion_flag", [0, 1]).agg(F.avg("units_sold"))
    return wide.withColumnsRenamed({"0": "no_promo", "1": "promo"})


def promo_fraction(df: DataFrame) -> DataFrame:
    return df.groupBy("sku_id").agg(F.avg("promotion_flag").alias("promo_frac"))


def profile(df: DataFrame) -> DataFrame:
    """Size, date range, missing cells per column and negative quantities in one pass, as rows."""
    columns = df.columns
    stats = df.agg(
        F.count(F.lit(1)).cast("string").alias("rows"),
        F.lit(str(len(columns))).alias("columns"),
        F.min("date").cast("string").alias("min_date"),
        F.max("date").cast("string").alias("max_date"),
        F.count_if(F.col("units_sold") < 0).cast("string").alias("negative_units"),
        *[F.count_if(F.col(c).isNull()).cast("string").alias(f"nulls_{c}") for c in columns])
    return stats.unpivot([], stats.columns, "measure", "value")


def distinct_skus(df: DataFrame) -> DataFrame:
    return df.select("sku_id").distinct()


def completeness(df: DataFrame) -> DataFrame:
    """Days present per product against the days of the whole table."""
    span = df.agg((F.date_diff(F.max("date"), F.min("date")) + 1).alias("days")).scalar()
    present = df.groupBy("sku_id", "date").agg(F.count(F.lit(1)).alias("rows"))
    return present.groupBy("sku_id").agg(
        F.count(F.lit(1)).alias("days_present"), F.sum("rows").alias("rows")
    ).withColumn("days_expected", span).withColumn(
        "complete", F.col("days_present") == F.col("days_expected"))


def row_count(df: DataFrame, location: str) -> DataFrame:
    """Rows present against one row per day, product and location."""
    sizes = df.agg(F.count(F.lit(1)).alias("rows"),
                   (F.date_diff(F.max("date"), F.min("date")) + 1).alias("days"),
                   F.count_distinct("sku_id").alias("skus"), F.count_distinct(location).alias("locations"))
    expected = F.col("days") * F.col("skus") * F.col("locations")
    return sizes.select("rows", expected.alias("expected"), (F.col("rows") == expected).alias("complete"))


def variant_summary(rows: DataFrame) -> DataFrame:
    """Summary and lift of several dataset variants in one job; ``rows`` carries ``variant``."""
    keys = ("variant", "sku_id")
    return rows.groupBy(*keys).agg(
        half_even(F.avg("units_sold"), 3).alias("mean_units"),
        half_even(F.stddev_samp("units_sold"), 3).alias("std_units"),
        half_even(F.avg("price"), 3).alias("mean_price"),
        half_even(F.avg("promotion_flag"), 3).alias("promo_frac"),
        F.avg(F.when(F.col("promotion_flag") == 0, F.col("units_sold"))).alias("no_promo"),
        F.avg(F.when(F.col("promotion_flag") == 1, F.col("units_sold"))).alias("promo"),
    ).select(
        *keys, "mean_units", "std_units", "mean_price", "promo_frac",
        half_even(F.col("no_promo"), 3).alias("mean_no_promo"),
        half_even(F.col("promo"), 3).alias("mean_promo"),
        half_even((F.col("promo") - F.col("no_promo")) / F.nullif(F.col("no_promo"), F.lit(0.0)), 3)
        .alias("relative_lift"))


def label_variants(variants: dict[str, DataFrame] | DataFrame, by: str | None = None) -> DataFrame:
    """Stack variants under one schema with their name as a column. Variants that lie in one table are
    told apart by its column ``by``, without a scan for each."""
    if by is not None:
        return variants.withColumnRenamed(by, "variant")
    frames = [df.withColumn("variant", F.lit(name)) for name, df in variants.items()]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


def sample_per_sku(df: DataFrame, row_key: list[str], size: int = 1000, seed: int = 0,
                   spread: int = 64, copy: Column | None = None) -> DataFrame:
    """Up to ``size`` rows per product, chosen by a hash of ``row_key``: the same rows every run. Where
    rows repeat, ``copy`` (the row's place, for instance) lets each copy be drawn for itself.

    The rank is taken twice: first within ``spread`` slices of each product, so that no task
    sorts a whole large product, then among the at most ``size * spread`` survivors.
    """
    parts = [F.col(c).cast("string") for c in row_key]
    drawn = df.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), *parts, *([copy] if copy is not None else []))))
    drawn = drawn.withColumn("_slice", F.pmod(F.hash("_h"), F.lit(spread)))
    order = [F.col("_h"), *[F.col(c) for c in df.columns]]
    for keys in (("sku_id", "_slice"), ("sku_id",)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        drawn = drawn.withColumn("_rank", rank).filter(F.col("_rank") <= size).drop("_rank")
    return drawn.drop("_h", "_slice")


def split_by_date(df: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the day, rows on or after it."""
    cut = F.lit(day).cast("date")
    return df.filter(F.col("date") < cut), df.filter(F.col("date") >= cut)
