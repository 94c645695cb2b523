"""Column expressions that turn messy text into typed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.let import let
from tidemark.schema import (BOOL_TOKENS, DEFAULT_PRICE, DEFAULT_UNITS, FIRST_DAY, LAST_DAY, NAMED_DAY,
                             NUMERIC_DAY, NUMERIC_PATTERN, TIME_SUFFIX, WEEKDAY_PREFIX)


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def number(df: DataFrame, name: str) -> Column:
    """Double value of a column, NULL where it holds no number."""
    col = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.when(col.rlike(NUMERIC_PATTERN), F.trim(col).try_cast("double"))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = col.cast("double")
        return F.when(~F.isnan(value), value)
    return col.cast("double")


def coerce_units(df: DataFrame, name: str = "units_sold") -> DataFrame:
    """Missing or non-numeric quantities, and those beyond whole numbers, count as one sale; fractions are cut toward zero."""
    if df.schema[name].dataType == T.LongType():
        return df.withColumn(name, F.coalesce(F.col(name), F.lit(DEFAULT_UNITS).cast("bigint")))
    return df.withColumn(name, F.coalesce(number(df, name).try_cast("bigint"), F.lit(DEFAULT_UNITS).cast("bigint")))


def coerce_price(df: DataFrame, name: str = "price") -> DataFrame:
    return df.withColumn(name, F.coalesce(number(df, name), F.lit(DEFAULT_PRICE)))


def reads_as_number(name: str) -> Column:
    """Aggregate: every present cell is a number."""
    col = F.col(name)
    return F.coalesce(F.bool_and(col.isNull() | col.rlike(NUMERIC_PATTERN)), F.lit(True))


def reads_as_flag(name: str) -> Column:
    """Aggregate: every cell is present and a boolean."""
    col = F.col(name)
    return F.coalesce(F.bool_and(col.isNotNull() & col.isin(BOOL_TOKENS)), F.lit(True))


def coerce_promo(df: DataFrame, name: str = "promotion_flag", as_label: bool | None = None) -> DataFrame:
    """0/1 (or integer) promotion flag.

    Whether a text column holds labels or numbers belongs to the whole column: one label makes
    every non-empty cell a promotion. Pass ``as_label`` when it was decided on a larger frame. Numbers beyond an
    integer are no promotion.
    """
    col = F.col(name)
    if not is_text(df, name):
        value = col.cast("int") if isinstance(df.schema[name].dataType, T.BooleanType) \
            else number(df, name).try_cast("int")
        return df.withColumn(name, F.coalesce(value, F.lit(0)))
    labels = F.lit(as_label) if as_label is not None else df.agg(
        (~(reads_as_number(name) | reads_as_flag(name))).alias("labels")).scalar()
    label = (col.isNotNull() & (F.length(col) > 0)).cast("int")
    value = F.when(F.lower(col) == "true", 1).when(F.lower(col) == "false", 0) \
        .otherwise(F.coalesce(number(df, name).try_cast("int"), F.lit(0)))
    return df.withColumn(name, F.when(labels, label).otherwise(value))


def unreadable_cells(df: DataFrame) -> DataFrame:
    """Cells that stand in the file but are not read as what their column holds: column, cell, rows.

    Dates that are none, quantities and prices that are no numbers, quantities and numeric promotions beyond whole
    numbers. Missing cells are not listed. Columns are the canonical ones, as far as ``df`` has them.
    """
    def cell(name: str, value: Column) -> Column:
        return F.when(F.col(name).isNotNull() & value.isNull(), F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("cell")))

    found = []
    if "date" in df.columns and is_text(df, "date"):
        found.append(cell("date", date_of(F.col("date"))))
    if "units_sold" in df.columns:
        found.append(cell("units_sold", number(df, "units_sold").try_cast("bigint")))
    if "price" in df.columns:
        found.append(cell("price", number(df, "price")))
    if "promotion_flag" in df.columns and not isinstance(df.schema["promotion_flag"].dataType, T.BooleanType):
        value = number(df, "promotion_flag")
        # Labels are read as they are; only numbers can be too large.
        found.append(cell("promotion_flag", F.when(value.isNull(), 0).otherwise(value.try_cast("int"))))
    if not found:
        return df.select(F.lit("").alias("column"), F.lit("").alias("cell"), F.lit(0).cast("long").alias("rows")).limit(0)
    return df.select(F.inline(F.array_compact(F.array(*found)))).groupBy("column", "cell").agg(F.count(F.lit(1)).alias("rows"))


def date_of(text: Column, pivot_year: int = 2075) -> Column:
    """Calendar day of a text, NULL when it is none.

    Read month first, day first only where the first number cannot be a month. Two-digit years
    after ``pivot_year`` belong to the previous century.
    """
    trimmed = F.trim(text)
    body = F.when(F.contains(trimmed, F.lit(":")), F.regexp_replace(trimmed, TIME_SUFFIX, "")).otherwise(trimmed)
    named = F.when(body.rlike("^[A-Za-z]"), F.regexp_replace(body, WEEKDAY_PREFIX, "")).otherwise(body)
    return let(named, lambda b: F.when(b.rlike(NUMERIC_DAY), _numeric_day(b, pivot_year))
               .when(b.rlike(NAMED_DAY), _named_day(b, pivot_year)))


def _full_year(year: Column, pivot_year: int) -> Column:
    return F.when(F.length(year) == 4, year).when(year.try_cast("int") + 2000 > pivot_year, F.concat(F.lit("19"), year)) \
        .otherwise(F.concat(F.lit("20"), year))


def _numeric_day(body: Column, pivot_year: int) -> Column:
    def arranged(parts: Column) -> Column:
        first, second, last = (F.get(parts, F.lit(i)) for i in range(3))
        day_first = (F.length(first) == 2) & (first > "12")
        eight = F.array(F.substring(first, 1, 4), F.substring(first, 5, 2), F.substring(first, 7, 2))
        return (F.when(F.size(parts) == 1, eight).when(F.size(parts) == 2, F.array(first, second, F.lit("01")))
                .when(F.length(first) == 4, parts)
                .when(day_first, F.array(_full_year(last, pivot_year), second, first))
                .otherwise(F.array(_full_year(last, pivot_year), first, second)))

    parts = F.split(F.translate(body, "/.", "--"), "-")
    return F.concat_ws("-", let(parts, arranged)).try_cast("date")


# Fixed value: places of the month names.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"


def _named_day(body: Column, pivot_year: int) -> Column:
    parts = F.split(F.translate(body, "-,", " "), " +")

    def arranged(parts: Column) -> Column:
        first, second, year = (F.get(parts, F.lit(i)) for i in range(3))
        month_first = first.rlike("^[A-Za-z]")
        name = F.lower(F.substring(F.when(month_first, first).otherwise(second), 1, 3))
        place = F.position(name, F.lit(MONTHS))
        return F.when(place > 0, F.array(
            _full_year(year, pivot_year), ((place + 3) / 4).cast("int").cast("string"),
            F.when(month_first, second).otherwise(first)))

    return let(let(parts, arranged), lambda day: F.when(day.isNotNull(), F.concat_ws("-", day).try_cast("date")))


def parse_dates(df: DataFrame, name: str = "date", pivot_year: int = 2075, keep_unreadable: bool = False) -> DataFrame:
    """Truncate to the day and drop rows without a readable date, or keep them with NULL."""
    day = date_of(F.col(name), pivot_year) if is_text(df, name) else F.col(name).cast("date")
    first, last = (F.lit(d).cast("date") for d in (FIRST_DAY, LAST_DAY))
    read = df.withColumn(name, let(day, lambda d: F.when(d.between(first, last), d)))
    return read if keep_unreadable else read.filter(F.col(name).isNotNull())
