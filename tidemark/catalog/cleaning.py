"""Sources, coercions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import (DAILY_FLOATS, DEMAND, EVENT_DAYS, MESSY, MESSY_CLEAN, MESSY_DAY, ORDER_DAYS,
                                   TOTAL_DAILY, daily_sql, demand, event_days, messy, messy_report,
                                   order_days, query, table, total_daily, with_brand)
from tidemark.functions.coerce import coerce_price, coerce_promo, coerce_units, parse_dates
from tidemark.functions.rounding import half_even, units_from_forecast
from tidemark.operators.clean import clip_iqr, filter_sku, filter_status, iqr_cap, keep_positive
from tidemark.operators.eda import split_by_date
from tidemark.operators.report import recent_window, zoom_window
from tidemark.plans.ingest import clean_sales, ingest
from tidemark.sources.sales import apply_aliases, canonical_columns, fill_default_columns, normalize_headers


@query("s02_normalize_headers", f"with {MESSY} select date_txt as date, qty_txt as qty, status, amount_txt as amount, "
       "promo_txt as \"promotion-ids\", category from messy")
def s02(spark, sf):
    return normalize_headers(messy_report(spark, sf))


@query("s03_apply_aliases", f"with {MESSY} select date_txt as date, qty_txt as units_sold, status, "
       "amount_txt as price, promo_txt as promotion_flag, category as sku_id from messy")
def s03(spark, sf):
    return apply_aliases(normalize_headers(messy_report(spark, sf)))


@query("s05_fill_default_columns",
       "select cast(o_orderdate as date) as date, 'DEFAULT_SKU' as sku_id, cast(1 as bigint) as units_sold, "
       "100.0 as price, 0 as promotion_flag from orders", dates="date", floats="price")
def s05(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return fill_default_columns(days)


@query("p01_filter_status", f"with {MESSY} select k, status from messy where lower(trim(status)) in "
       "('shipped', 'shipped - delivered to buyer', 'delivered')")
def p01(spark, sf):
    return filter_status(messy(spark, sf)).select("k", "status")


@query("p02_coerce_units", f"with {MESSY} select k, cast(trunc(coalesce(try_cast(qty_txt as double), 1)) as bigint) "
       "as qty_txt from messy")
def p02(spark, sf):
    return coerce_units(messy(spark, sf), "qty_txt").select("k", "qty_txt")


@query("p03_clip_iqr", f"""with {EVENT_DAYS},
cap as (select quantile_cont(units_sold, 0.75)
          + 1.5 * (quantile_cont(units_sold, 0.75) - quantile_cont(units_sold, 0.25)) as cap from demand)
select date, sku_id, cast(sum(least(cast(units_sold as double), cap)) as double) as capped_units,
       cast(sum(units_sold) as bigint) as units, max(cap) as cap
from demand, cap group by date, sku_id""", dates="date", floats="capped_units cap")
def p03(spark, sf):
    rows = event_days(spark, sf)
    cap = iqr_cap(rows).first()["cap"]
    return clip_iqr(rows.withColumn("raw", F.col("units_sold")), cap=cap).groupBy("date", "sku_id").agg(
        F.sum("units_sold").alias("capped_units"), F.sum("raw").alias("units"),
        F.lit(cap).alias("cap"))


@query("p04_keep_positive", f"with {MESSY_CLEAN} select sku_id, count(*) as n, sum(units_sold) as units "
       "from clean group by sku_id", floats="units")
def p04(spark, sf):
    rows = coerce_units(filter_status(canonical_columns(messy_report(spark, sf))))
    return keep_positive(clip_iqr(rows)).groupBy("sku_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("units_sold").alias("units"))


@query("p05_coerce_price", f"with {MESSY} select k, coalesce(try_cast(nullif(amount_txt, '') as double), 100.0) "
       "as amount_txt from messy", floats="amount_txt")
def p05(spark, sf):
    return coerce_price(messy(spark, sf), "amount_txt").select("k", "amount_txt")


@query("p06_coerce_promo", f"with {MESSY} select k, case when promo_txt is not null and length(promo_txt) > 0 "
       "then 1 else 0 end as promo_txt, coalesce(cast(try_cast(qty_txt as double) as integer), 0) * 0 + "
       "case when qty_txt is null then 0 else 1 end as qty_txt from messy")
def p06(spark, sf):
    rows = messy(spark, sf)
    return coerce_promo(coerce_promo(rows, "promo_txt"), "qty_txt").select("k", "promo_txt", "qty_txt")


@query("p07_parse_dates", f"with {MESSY} select k, {MESSY_DAY} as date_txt from messy where {MESSY_DAY} is not null",
       dates="date_txt")
def p07(spark, sf):
    return parse_dates(messy(spark, sf), "date_txt").select("k", "date_txt")


@query("p08_filter_sku", f"with {DEMAND} select date, sku_id, units_sold, price, promotion_flag from demand "
       "where sku_id = 'Brand#13'", dates="date", floats="price")
def p08(spark, sf):
    return filter_sku(demand(spark, sf), "Brand#13")


@query("p09_split_by_date", f"with {DEMAND} select case when date < date '2000-01-01' then 'train' else 'test' end "
       "as part, count(*) as n, cast(sum(units_sold) as bigint) as units, min(date) as first_day, max(date) as last_day "
       "from demand group by 1", dates="first_day last_day")
def p09(spark, sf):
    train, test = split_by_date(demand(spark, sf), "2000-01-01")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("units_sold").alias("units"),
                                    F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@query("p10_recent_window", f"with {DEMAND} select date, sku_id, cast(sum(units_sold) as bigint) as units from demand "
       "where date > (select max(date) from demand) - interval 28 day group by date, sku_id", dates="date")
def p10(spark, sf):
    return recent_window(demand(spark, sf)).groupBy("date", "sku_id").agg(F.sum("units_sold").alias("units"))


@query("p11_feature_columns", TOTAL_DAILY + " select series_id, date, total_units, avg_price, promo_any, dow_sin, "
       "dow_cos, doy_sin, doy_cos from daily", dates="date", floats=DAILY_FLOATS)
def p11(spark, sf):
    from tidemark.operators.features import feature_columns

    return total_daily(spark, sf).select("series_id", "date", *feature_columns())


@query("p12_units_from_forecast", "select o_orderkey, cast(round_even(greatest((o_totalprice - 250000) / 1000, 0), 0) "
       "as bigint) as units from orders")
def p12(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", units_from_forecast((F.col("o_totalprice") - 250000) / 1000).alias("units"))


@query("p13_half_even", "select l_orderkey, l_linenumber, l_quantity, "
       "cast(round_even(l_quantity / 2, 0) as bigint) as whole, round_even(l_quantity / 8, 1) as tenth, "
       "round_even(l_quantity / 16, 3) as thousandth from lineitem", floats="l_quantity tenth thousandth")
def p13(spark, sf):
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", half_even(q / 2).cast("bigint").alias("whole"),
        half_even(q / 8, 1).alias("tenth"), half_even(q / 16, 3).alias("thousandth"))


@query("p14_zoom_window", TOTAL_DAILY + " select series_id, date, total_units from daily where date >= "
       "(select greatest(min(date), max(date) - interval 180 day) from daily)", dates="date")
def p14(spark, sf):
    return zoom_window(total_daily(spark, sf)).select("series_id", "date", "total_units")


@query("clean_sales_messy_report", f"with {MESSY_CLEAN} select sku_id, count(*) as n, sum(units_sold) as units, "
       "sum(price) as price, cast(sum(promotion_flag) as bigint) as promoted, min(date) as first_day, "
       "max(date) as last_day from clean where date is not null group by sku_id",
       dates="first_day last_day", floats="units price", digits=2)
def clean_messy(spark, sf):
    return clean_sales(messy_report(spark, sf)).groupBy("sku_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("units_sold").alias("units"), F.sum("price").alias("price"),
        F.sum("promotion_flag").alias("promoted"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@query("ingest_messy_report", f"with {MESSY_CLEAN},\n{daily_sql('clean')} select * from daily",
       dates="date", floats=DAILY_FLOATS)
def ingest_messy(spark, sf):
    return ingest(messy_report(spark, sf))


@query("s09_short_series", f"with {EVENT_DAYS},\n{daily_sql(by='sku_id')} select series_id, count(*) as n_days "
       "from daily group by series_id having count(*) < 90")
def s09(spark, sf):
    from tidemark.operators.series import daily_series, short_series

    return short_series(daily_series(event_days(spark, sf), "sku_id"), 90)


@query("s10_completeness", f"""with {DEMAND} select sku_id, count(distinct date) as days_present, count(*) as rows,
  (select date_diff('day', min(date), max(date)) + 1 from demand) as days_expected,
  count(distinct date) = (select date_diff('day', min(date), max(date)) + 1 from demand) as complete
from demand group by sku_id""")
def s10(spark, sf):
    from tidemark.operators.eda import completeness

    return completeness(demand(spark, sf)).withColumn("days_expected", F.col("days_expected").cast("bigint"))


@query("s10_row_count", """with r as (select count(*) as rows, date_diff('day', min(d), max(d)) + 1 as days,
  count(distinct p_brand) as skus, count(distinct l_suppkey) as locations
  from (select cast(l_shipdate as date) as d, p_brand, l_suppkey from lineitem join part on l_partkey = p_partkey))
select rows, days * skus * locations as expected, rows = days * skus * locations as complete from r""")
def s10_rows(spark, sf):
    from tidemark.operators.eda import row_count

    return row_count(with_brand(spark, sf).select(
        F.col("p_brand").alias("sku_id"), "l_suppkey", F.col("l_shipdate").cast("date").alias("date")), "l_suppkey")


@query("j01_densify_orders", f"with {ORDER_DAYS},\n{daily_sql()} select series_id, date, total_units, avg_price from daily",
       dates="date", floats="avg_price")
def j01_orders(spark, sf):
    from tidemark.operators.series import daily_series

    return daily_series(order_days(spark, sf)).select("series_id", "date", "total_units", "avg_price")
