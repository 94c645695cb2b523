"""Sales rows to daily series: the cleaning order decides the result, so it lives in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.functions.coerce import (coerce_price, coerce_promo, coerce_units, is_text, number, parse_dates,
                                       reads_as_flag, reads_as_number)
from tidemark.operators.clean import cap_at, filter_sku, filter_status, iqr_cap, is_sold, keep_positive
from tidemark.operators.series import daily_series
from tidemark.sources.sales import (apply_aliases, canonical_columns, fill_default_columns, history_columns,
                                    normalize_headers, read_sales, require_columns)


def table_facts(named: DataFrame) -> tuple[float | None, bool | None]:
    """What cleaning must know about the whole table, from one pass over it: the cap of the units
    of sold rows, and whether a text promotion column holds labels (all rows count).

    The pass leaves one row per distinct quantity; both facts come from that small table.
    """
    sold = is_sold() if "status" in named.columns else F.lit(True)
    counted = [F.count_if(sold).alias("n")]
    textual = is_text(named, "promotion_flag")
    if textual:
        counted += [reads_as_number("promotion_flag").alias("number"), reads_as_flag("promotion_flag").alias("flag")]
    counts = coerce_units(named).groupBy("units_sold").agg(*counted).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        labels = None
        if textual:
            labels = not any(counts.agg(F.coalesce(F.bool_and("number"), F.lit(True)),
                                        F.coalesce(F.bool_and("flag"), F.lit(True))).first())
        return iqr_cap(counts, weight="n").first()["cap"], labels
    finally:
        counts.unpersist()


def clean_sales(raw: DataFrame, sku: str | None = None, cap: float | None = None) -> DataFrame:
    """Canonical, typed, capped sales rows of any file with a date column.

    The cap and the text-or-number decision of the promotion column look at rows that later
    filters drop, so both are taken before those filters. A given ``cap`` is used instead.
    """
    named = canonical_columns(raw)
    own_cap, labels = table_facts(named)
    sold = keep_positive(cap_at(coerce_units(filter_status(named)), own_cap if cap is None else cap))
    rows = parse_dates(coerce_promo(coerce_price(sold), as_label=labels)).select(
        "date", F.col("sku_id").cast("string").alias("sku_id"), "units_sold", "price", "promotion_flag")
    return filter_sku(rows, sku) if sku is not None else rows


def ingest(raw: DataFrame, sku: str | None = None, by: str | Column | None = None,
           cap: float | None = None) -> DataFrame:
    """Gap-free daily series with calendar features, one total series or one per ``by``."""
    return daily_series(clean_sales(raw, sku, cap), by)


def raw_rows(raw: DataFrame) -> DataFrame:
    """Typed rows of a file as it is: all its columns, nothing filled in, no row left out. A missing or
    unreadable date, quantity, price or flag is NULL."""
    named = fill_default_columns(require_columns(apply_aliases(normalize_headers(raw)), ["date"]))
    flagged = coerce_promo(named.withColumn("_given", F.col("promotion_flag")))
    flag = F.when(F.col("_given").isNotNull(), F.col("promotion_flag"))
    typed = flagged.withColumns({"promotion_flag": flag, "units_sold": number(named, "units_sold"), "price": number(named, "price")})
    return parse_dates(typed.drop("_given"), keep_unreadable=True).withColumn("sku_id", F.col("sku_id").cast("string"))


def load_series(spark: SparkSession, path: str, sku: str | None = None,
                by: str | Column | None = None) -> DataFrame:
    return ingest(read_sales(spark, path), sku, by)


def raw_history(raw: DataFrame) -> DataFrame:
    """Rows for the product shares: narrow spellings, no status filter, no cap, no coercion of
    missing quantities (a missing one adds nothing)."""
    named = history_columns(raw)
    rows = parse_dates(named.withColumn("units_sold", number(named, "units_sold")))
    return rows.withColumn("sku_id", F.col("sku_id").cast("string"))
