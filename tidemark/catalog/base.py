"""Registration of queries, the demand views over the tables and shared SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.series import daily_series

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def presentable(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """ISO text for days and rounded doubles, so two engines can be compared."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.DoubleType):
            scaled = F.floor(F.abs(col) * F.lit(10.0 ** digits) + 0.5) / F.lit(10.0 ** digits)
            col = F.when(col < 0, 0.0 - scaled).otherwise(scaled)
        out.append(col.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, dates: str = "", floats: str = "", digits: int = DIGITS):
    """Register ``fn(spark, sf_dir)``; ``dates`` and ``floats`` name the SQL columns that get the
    treatment of :func:`presentable`."""

    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf: presentable(fn(spark, sf), digits)
        if sql is not None:
            changes = [f'strftime("{c}", \'%Y-%m-%d\') as "{c}"' for c in dates.split()]
            changes += [f'round(cast("{c}" as double), {digits}) + 0.0 as "{c}"' for c in floats.split()]
            star = f"* replace ({', '.join(changes)})" if changes else "*"
            ORACLES[name] = f"select {star} from (\n{sql.strip()}\n) as q"
        return fn

    return wrap


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def with_brand(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with the brand of their part. The parts grow with the sales, and by its estimate from the size of
    the file Spark would send a million of them through the driver, once for every use: both sides are shuffled."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand").hint("merge")
    lines = table(spark, sf, "lineitem")
    return lines.join(part, lines.l_partkey == part.p_partkey)


def demand(spark: SparkSession, sf: str) -> DataFrame:
    """Sales rows with 25 brands as products."""
    return with_brand(spark, sf).select(*_line_columns(F.col("p_brand")))


def part_demand(spark: SparkSession, sf: str) -> DataFrame:
    """The many-series variant: every part is a product."""
    return table(spark, sf, "lineitem").select(*_line_columns(F.col("l_partkey").cast("string")))


def _line_columns(sku):
    return (F.col("l_shipdate").cast("date").alias("date"), sku.alias("sku_id"),
            F.col("l_quantity").cast("bigint").alias("units_sold"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            (F.col("l_discount") >= 0.05).cast("int").alias("promotion_flag"))


def variants(spark: SparkSession, sf: str) -> DataFrame:
    """Demand with the return flag as dataset variant."""
    return with_brand(spark, sf).select(
        F.col("l_returnflag").alias("variant"), *_line_columns(F.col("p_brand")))


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"), F.lit("orders").alias("sku_id"),
        F.lit(1).cast("bigint").alias("units_sold"), F.col("o_totalprice").alias("price"),
        F.lit(0).alias("promotion_flag"))


def event_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("date"), F.col("event_type").alias("sku_id"),
        F.floor("value").cast("bigint").alias("units_sold"), F.lit(100.0).alias("price"),
        F.lit(0).alias("promotion_flag"))


# Notations of the report's days, as Spark and as SQL patterns.
MESSY_DATES = {
    "yyyy/MM/dd": "%Y/%m/%d", "dd-MMM-yy": "%d-%b-%y", "dd-MMM-yyyy": "%d-%b-%Y", "MMM-dd-yyyy": "%b-%d-%Y",
    "yyyy.MM.dd": "%Y.%m.%d", "dd.MM.yyyy": "%d.%m.%Y", "MM/dd/yyyy '10:30 PM'": "%m/%d/%Y 10:30 PM",
    "yyyy-MM-dd '12:00:00 AM'": "%Y-%m-%d 12:00:00 AM", "EEE, dd MMM yyyy": "%a, %d %b %Y", "yyyy-MM": "%Y-%m"}


def messy(spark: SparkSession, sf: str) -> DataFrame:
    """A marketplace report made of text columns, derived from the orders."""
    key = F.col("o_orderkey")

    def fmt(pattern: str):
        return F.date_format("o_orderdate", pattern)

    return table(spark, sf, "orders").select(
        key.alias("k"),
        F.when(key % 4 == 0, fmt("yyyy-MM-dd")).when(key % 4 == 1, fmt("MM-dd-yy"))
        .when(key % 4 == 2, fmt("M/d/yyyy"))
        .otherwise(F.when(key % 101 == 0, "junk").when(key % 103 == 0, "0022-04-30")
                   .otherwise(F.element_at(F.array(*[fmt(p) for p in MESSY_DATES]),
                                           (key % len(MESSY_DATES) + 1).cast("int")))).alias("date_txt"),
        F.when(key % 17 == 0, "x").when(key % 23 == 0, None).when(key % 97 == 0, "500")
        .otherwise((key % 9 - 1).cast("string")).alias("qty_txt"),
        F.when(F.col("o_orderstatus") == "F", "Shipped")
        .when(F.col("o_orderstatus") == "O", " Shipped - Delivered to Buyer ")
        .otherwise("Pending").alias("status"),
        F.when(key % 19 == 0, "").otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
        .alias("amount_txt"),
        F.when(key % 5 == 0, "PROMO-1").alias("promo_txt"),
        F.col("o_orderpriority").alias("category"))


def messy_report(spark: SparkSession, sf: str) -> DataFrame:
    """The same report under the headers a marketplace would use."""
    return messy(spark, sf).select(
        F.col("date_txt").alias(" Date"), F.col("qty_txt").alias("Qty"), F.col("status").alias("Status"),
        F.col("amount_txt").alias("Amount"), F.col("promo_txt").alias("promotion-ids"),
        F.col("category").alias("Category"))


def total_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily_series(demand(spark, sf))


def sku_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily_series(demand(spark, sf), "sku_id")


def sku_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Daily brand demand in the shape of a forecast, for reports that need no fitted model."""
    daily = sku_daily(spark, sf)
    return daily.select(F.col("series_id").alias("sku_id"), "date",
                        F.col("total_units").cast("double").alias("predicted_units"))


BRANDS = [f"Brand#{i}" for i in range(1, 26)]

# ---------------------------------------------------------------- SQL fragments

DEMAND = """demand as (
  select cast(l_shipdate as date) as date, p_brand as sku_id, cast(l_quantity as bigint) as units_sold,
         l_extendedprice / l_quantity as price, l_returnflag as variant,
         case when l_discount >= 0.05 then 1 else 0 end as promotion_flag
  from lineitem join part on l_partkey = p_partkey)"""

PART_DEMAND = """demand as (
  select cast(l_shipdate as date) as date, cast(l_partkey as varchar) as sku_id,
         cast(l_quantity as bigint) as units_sold, l_extendedprice / l_quantity as price,
         case when l_discount >= 0.05 then 1 else 0 end as promotion_flag
  from lineitem)"""

ORDER_DAYS = """demand as (
  select cast(o_orderdate as date) as date, 'orders' as sku_id, 1 as units_sold,
         o_totalprice as price, 0 as promotion_flag from orders)"""

EVENT_DAYS = """demand as (
  select cast(ts as date) as date, event_type as sku_id, cast(floor(value) as bigint) as units_sold,
         100.0 as price, 0 as promotion_flag from events)"""

MESSY = """messy as (
  select o_orderkey as k,
    case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then strftime(o_orderdate, '%m-%d-%y')
      when 2 then strftime(o_orderdate, '%-m/%-d/%Y')
      else case when o_orderkey % 101 = 0 then 'junk' when o_orderkey % 103 = 0 then '0022-04-30'
        else [""" + ", ".join(f"strftime(o_orderdate, '{p}')" for p in MESSY_DATES.values()) + """
          ][o_orderkey % """ + str(len(MESSY_DATES)) + """ + 1] end end as date_txt,
    case when o_orderkey % 17 = 0 then 'x' when o_orderkey % 23 = 0 then null when o_orderkey % 97 = 0 then '500'
      else cast(o_orderkey % 9 - 1 as varchar) end as qty_txt,
    case o_orderstatus when 'F' then 'Shipped' when 'O' then ' Shipped - Delivered to Buyer ' else 'Pending' end
      as status,
    case when o_orderkey % 19 = 0 then '' else cast(cast(o_totalprice as decimal(12,2)) as varchar) end as amount_txt,
    case when o_orderkey % 5 = 0 then 'PROMO-1' end as promo_txt,
    o_orderpriority as category
  from orders)"""

MESSY_DAY = """cast(case when regexp_full_match(date_txt, '[12]\\d{3}-\\d{2}-\\d{2}') then strptime(date_txt, '%Y-%m-%d')
    when regexp_full_match(date_txt, '\\d{2}-\\d{2}-\\d{2}') then strptime(date_txt, '%m-%d-%y')
    when regexp_full_match(date_txt, '\\d{1,2}/\\d{1,2}/\\d{4}') then strptime(date_txt, '%m/%d/%Y')
    when regexp_full_match(date_txt, '\\d{4}/\\d{2}/\\d{2}') then strptime(date_txt, '%Y/%m/%d')
    when regexp_full_match(date_txt, '\\d{2}-[A-Z][a-z]{2}-\\d{2}') then strptime(date_txt, '%d-%b-%y')
    when regexp_full_match(date_txt, '\\d{2}-[A-Z][a-z]{2}-\\d{4}') then strptime(date_txt, '%d-%b-%Y')
    when regexp_full_match(date_txt, '[A-Z][a-z]{2}-\\d{2}-\\d{4}') then strptime(date_txt, '%b-%d-%Y')
    when regexp_full_match(date_txt, '\\d{4}\\.\\d{2}\\.\\d{2}') then strptime(date_txt, '%Y.%m.%d')
    when regexp_full_match(date_txt, '\\d{2}\\.\\d{2}\\.\\d{4}') and date_txt[1:2] > '12' then strptime(date_txt, '%d.%m.%Y')
    when regexp_full_match(date_txt, '\\d{2}\\.\\d{2}\\.\\d{4}') then strptime(date_txt, '%m.%d.%Y')
    when date_txt like '% PM' then strptime(date_txt, '%m/%d/%Y %I:%M %p')
    when date_txt like '% AM' then strptime(date_txt, '%Y-%m-%d %I:%M:%S %p')
    when date_txt like '%, %' then strptime(date_txt, '%a, %d %b %Y')
    when regexp_full_match(date_txt, '\\d{4}-\\d{2}') then strptime(date_txt || '-01', '%Y-%m-%d') end as date)"""

# Rows of the messy report after cleaning, before the day is parsed.
MESSY_CLEAN = MESSY + """,
sold as (
  select *, cast(trunc(coalesce(try_cast(qty_txt as double), 1)) as bigint) as units from messy
  where lower(trim(status)) in ('shipped', 'shipped - delivered to buyer', 'delivered')),
cap as (
  select quantile_cont(units, 0.75) + 1.5 * (quantile_cont(units, 0.75) - quantile_cont(units, 0.25)) as cap from sold),
clean as (
  select """ + MESSY_DAY + """ as date, category as sku_id, least(cast(units as double), cap) as units_sold,
    coalesce(try_cast(nullif(amount_txt, '') as double), 100.0) as price,
    case when promo_txt is not null and length(promo_txt) > 0 then 1 else 0 end as promotion_flag
  from sold, cap where least(units, cap) > 0)"""


def daily_sql(source: str = "demand", by: str | None = None) -> str:
    """CTEs from sales rows to the dense daily series."""
    key = f"cast({by} as varchar)" if by else "'ALL'"
    return f"""agg as (
  select {key} as series_id, date, sum(units_sold) as total_units, avg(price) as avg_price,
         max(promotion_flag) as promo_any
  from {source} where date is not null group by all),
cal as (
  select series_id, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
  from agg group by series_id),
dense as (
  select series_id, date, cast(trunc(coalesce(total_units, 0)) as bigint) as total_units, avg_price,
         cast(coalesce(promo_any, 0) as integer) as promo_any
  from cal left join agg using (series_id, date)),
daily as (
  select series_id, date, total_units, coalesce(
      last_value(avg_price ignore nulls) over (partition by series_id order by date
        rows between unbounded preceding and current row),
      first_value(avg_price ignore nulls) over (partition by series_id order by date
        rows between current row and unbounded following)) as avg_price,
    promo_any, cast((dayofweek(date) + 6) % 7 as integer) as dow,
    sin(2 * pi() * ((dayofweek(date) + 6) % 7) / 7) as dow_sin,
    cos(2 * pi() * ((dayofweek(date) + 6) % 7) / 7) as dow_cos,
    sin(2 * pi() * dayofyear(date) / 365.25) as doy_sin,
    cos(2 * pi() * dayofyear(date) / 365.25) as doy_cos
  from dense)"""


DAILY_FLOATS = "avg_price dow_sin dow_cos doy_sin doy_cos"
TOTAL_DAILY = f"with {DEMAND},\n{daily_sql()}"
SKU_DAILY = f"with {DEMAND},\n{daily_sql(by='sku_id')}"
FORECAST = SKU_DAILY + """,
forecast as (
  select series_id as sku_id, date, cast(total_units as double) as predicted_units from daily)"""
