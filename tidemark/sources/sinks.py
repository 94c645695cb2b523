"""CSV exports. Each writes a folder of part files, so nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_csv(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(folder)


def forecast_export(daily: DataFrame) -> DataFrame:
    """Export layout of a forecast: averages with one decimal, blank where missing."""
    def one_decimal(name: str):
        return F.coalesce(F.bround(F.col(name), 1).cast("decimal(28,1)").cast("string"), F.lit(""))

    return daily.select(
        F.date_format("date", "yyyy-MM-dd").alias("Date"),
        F.col("predicted_units").alias("Predicted Units"),
        one_decimal("ma7").alias("MA7"),
        one_decimal("ma14").alias("MA14"),
        F.col("sku_id").alias("SKU"))


def write_variant_sets(train: DataFrame, test: DataFrame, folder: str) -> None:
    """Full, train and test sets, one sub-folder per variant."""
    for name, part in (("full", train.unionByName(test)), ("train", train), ("test", test)):
        (part.write.mode("overwrite").option("header", True).partitionBy("variant")
         .csv(f"{folder}/{name}"))
