"""Aggregations of sales rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import (BRANDS, DAILY_FLOATS, DEMAND, MESSY, MESSY_DAY, PART_DEMAND, SKU_DAILY, TOTAL_DAILY,
                                   daily_sql, demand, messy_report, part_demand, query, sku_daily, total_daily,
                                   variants, with_brand)
from tidemark.operators import eda
from tidemark.operators.horizon import sku_shares
from tidemark.operators.series import daily_aggregate, daily_series, daily_total, with_series
from tidemark.plans.explore import explore
from tidemark.plans.ingest import raw_rows


@query("a01_daily_aggregate", f"with {DEMAND} select 'ALL' as series_id, date, cast(sum(units_sold) as bigint) as "
       "total_units, avg(price) as avg_price, max(promotion_flag) as promo_any from demand group by date",
       dates="date", floats="avg_price")
def a01(spark, sf):
    return daily_aggregate(with_series(demand(spark, sf)))


@query("daily_series_total", TOTAL_DAILY + " select * from daily", dates="date", floats=DAILY_FLOATS)
def series_total(spark, sf):
    return total_daily(spark, sf)


@query("daily_series_per_sku", SKU_DAILY + " select * from daily", dates="date", floats=DAILY_FLOATS)
def series_per_sku(spark, sf):
    return sku_daily(spark, sf)


@query("daily_series_per_part", f"with {PART_DEMAND},\n{daily_sql(by='sku_id')} select series_id, count(*) as n_days, "
       "cast(sum(total_units) as bigint) as units, avg(avg_price) as mean_price, "
       "cast(sum(promo_any) as bigint) as promo_days from daily group by series_id", floats="mean_price", digits=4)
def series_per_part(spark, sf):
    return daily_series(part_demand(spark, sf), "sku_id").groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_days"), F.sum("total_units").alias("units"),
        F.avg("avg_price").alias("mean_price"), F.sum("promo_any").alias("promo_days"))


SUMMARY = """round_even(avg(units_sold), 3) as mean_units, round_even(stddev_samp(units_sold), 3) as std_units,
  round_even(avg(price), 3) as mean_price, round_even(avg(promotion_flag), 3) as promo_frac"""
NO, YES = ("avg(units_sold) filter (where promotion_flag = 0)", "avg(units_sold) filter (where promotion_flag = 1)")


@query("a02_per_sku_summary", f"with {DEMAND} select sku_id, {SUMMARY} from demand group by sku_id",
       floats="mean_units std_units mean_price promo_frac")
def a02(spark, sf):
    return eda.per_sku_summary(demand(spark, sf))


@query("a02_per_sku_summary_parts", f"with {PART_DEMAND} select sku_id, {SUMMARY} from demand group by sku_id",
       floats="mean_units std_units mean_price promo_frac")
def a02_parts(spark, sf):
    return eda.per_sku_summary(part_demand(spark, sf))


@query("a03_promo_lift", f"with {DEMAND} select sku_id, {NO} as mean_no_promo, {YES} as mean_promo, "
       f"({YES} - {NO}) / nullif({NO}, 0) as relative_lift from demand group by sku_id",
       floats="mean_no_promo mean_promo relative_lift")
def a03(spark, sf):
    return eda.promo_lift(demand(spark, sf))


@query("a03_promo_lift_parts", f"with {PART_DEMAND} select sku_id, {NO} as mean_no_promo, {YES} as mean_promo, "
       f"({YES} - {NO}) / nullif({NO}, 0) as relative_lift from demand group by sku_id",
       floats="mean_no_promo mean_promo relative_lift")
def a03_parts(spark, sf):
    return eda.promo_lift(part_demand(spark, sf))


@query("a04_daily_total", f"with {DEMAND} select date, cast(sum(units_sold) as bigint) as total_units from demand "
       "group by date", dates="date")
def a04(spark, sf):
    return daily_total(demand(spark, sf))


@query("a05_weekday_profile", f"with {DEMAND} select sku_id, cast((dayofweek(date) + 6) % 7 as integer) as weekday, "
       "avg(units_sold) as mean_units from demand group by all", floats="mean_units")
def a05(spark, sf):
    return eda.weekday_profile(demand(spark, sf))


_BRAND_AVG = ", ".join(f"avg(units_sold) filter (where sku_id = '{b}') as \"{b}\"" for b in BRANDS)


@query("a05_weekday_matrix", f"""with {DEMAND} select cast((dayofweek(date) + 6) % 7 as integer) as weekday,
  ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][(dayofweek(date) + 6) % 7 + 1] as day, {_BRAND_AVG}
from demand group by all""", floats=" ".join(BRANDS))
def a05_matrix(spark, sf):
    return eda.weekday_matrix(demand(spark, sf))


@query("a06_promo_matrix", f"with {DEMAND} select sku_id, {NO} as no_promo, {YES} as promo from demand group by sku_id",
       floats="no_promo promo")
def a06(spark, sf):
    return eda.promo_matrix(demand(spark, sf))


@query("a07_promo_fraction", f"with {DEMAND} select sku_id, avg(promotion_flag) as promo_frac from demand group by sku_id",
       floats="promo_frac")
def a07(spark, sf):
    return eda.promo_fraction(demand(spark, sf))


_PROFILE_COLS = ["date", "sku_id", "units_sold", "price", "promotion_flag"]


@query("a08_profile", f"""with {DEMAND}, s as (select count(*) as rows, 5 as columns, min(date) as min_date,
  max(date) as max_date, count(*) filter (where units_sold < 0) as negative_units,
  {', '.join(f'count(*) - count({c}) as nulls_{c}' for c in _PROFILE_COLS)} from demand)
select unnest(['rows', 'columns', 'min_date', 'max_date', 'negative_units',
               {', '.join(f"'nulls_{c}'" for c in _PROFILE_COLS)}]) as measure,
       unnest([cast(rows as varchar), cast(columns as varchar), cast(min_date as varchar), cast(max_date as varchar),
               cast(negative_units as varchar),
               {', '.join(f'cast(nulls_{c} as varchar)' for c in _PROFILE_COLS)}]) as value from s""")
def a08(spark, sf):
    return eda.profile(demand(spark, sf))


MESSY_RAW = MESSY + ", raw as (select " + MESSY_DAY + """ as date, category as sku_id, try_cast(qty_txt as double) as units_sold,
  try_cast(nullif(amount_txt, '') as double) as price,
  case when promo_txt is not null then cast(length(promo_txt) > 0 as integer) end as promotion_flag, status from messy)"""
_RAW_COLS = [*_PROFILE_COLS, "status"]


@query("a08_profile_messy", f"""with {MESSY_RAW}, s as (select count(*) as rows, 6 as columns, min(date) as min_date,
  max(date) as max_date, count(*) filter (where units_sold < 0) as negative_units,
  {', '.join(f'count(*) - count({c}) as nulls_{c}' for c in _RAW_COLS)} from raw)
select unnest(['rows', 'columns', 'min_date', 'max_date', 'negative_units',
               {', '.join(f"'nulls_{c}'" for c in _RAW_COLS)}]) as measure,
       unnest([cast(rows as varchar), cast(columns as varchar), cast(min_date as varchar), cast(max_date as varchar),
               cast(negative_units as varchar), {', '.join(f'cast(nulls_{c} as varchar)' for c in _RAW_COLS)}]) as value from s""")
def a08_messy(spark, sf):
    return explore(raw_rows(messy_report(spark, sf)))["profile"]


@query("a02_per_sku_summary_messy", f"with {MESSY_RAW} select sku_id, {SUMMARY} from raw where date is not null group by sku_id",
       floats="mean_units std_units mean_price promo_frac", digits=3)
def a02_messy(spark, sf):
    return explore(raw_rows(messy_report(spark, sf)))["per_sku_summary"]


@query("a03_promo_summary_messy", f"""with {MESSY_RAW} select sku_id, round_even({NO}, 3) as mean_no_promo,
  round_even({YES}, 3) as mean_promo, round_even(({YES} - {NO}) / nullif({NO}, 0), 3) as relative_lift
  from raw where date is not null group by sku_id""", floats="mean_no_promo mean_promo relative_lift", digits=3)
def a03_messy(spark, sf):
    return explore(raw_rows(messy_report(spark, sf)))["promo_summary"]


@query("a14_sku_shares", f"""with {DEMAND}, cut as (select max(date) - interval 28 day as cut from demand),
sums as (select sku_id, coalesce(sum(units_sold) filter (where date > cut), 0) as recent, sum(units_sold) as ever
         from demand, cut group by sku_id)
select sku_id, case when sum(recent) over () > 0 then recent / sum(recent) over ()
                    when sum(ever) over () > 0 then ever / sum(ever) over () else 1.0 / count(*) over () end as share
from sums""", floats="share")
def a14(spark, sf):
    return sku_shares(demand(spark, sf))


@query("a14_sku_shares_parts", f"""with {PART_DEMAND}, cut as (select max(date) - interval 28 day as cut from demand),
sums as (select sku_id, coalesce(sum(units_sold) filter (where date > cut), 0) as recent, sum(units_sold) as ever
         from demand, cut group by sku_id)
select sku_id, case when sum(recent) over () > 0 then recent / sum(recent) over ()
                    when sum(ever) over () > 0 then ever / sum(ever) over () else 1.0 / count(*) over () end as share
from sums""", floats="share")
def a14_parts(spark, sf):
    return sku_shares(part_demand(spark, sf))


@query("a16_distinct_skus", f"with {DEMAND} select distinct sku_id from demand")
def a16(spark, sf):
    return eda.distinct_skus(demand(spark, sf))


@query("a17_variant_summary", f"""with {DEMAND} select variant, sku_id, {SUMMARY},
  round_even({NO}, 3) as mean_no_promo, round_even({YES}, 3) as mean_promo,
  round_even(({YES} - {NO}) / nullif({NO}, 0), 3) as relative_lift from demand group by variant, sku_id""",
       floats="mean_units std_units mean_price promo_frac mean_no_promo mean_promo relative_lift")
def a17(spark, sf):
    return eda.variant_summary(variants(spark, sf))


@query("u02_concat_variants", f"with {DEMAND} select variant, count(*) as n, cast(sum(units_sold) as bigint) as units "
       "from demand group by variant")
def u02(spark, sf):
    rows = variants(spark, sf).withColumnRenamed("variant", "flag")
    return eda.label_variants(rows, "flag").groupBy("variant").agg(
        F.count(F.lit(1)).alias("n"), F.sum("units_sold").alias("units"))


@query("o01_order_rows", f"with {DEMAND} select date, sku_id, units_sold, price from demand order by date, sku_id",
       dates="date", floats="price", digits=9)
def o01(spark, sf):
    return demand(spark, sf).select("date", "sku_id", "units_sold", "price").orderBy("date", "sku_id")


@query("o03_first_days", f"with {DEMAND} select date, cast(sum(units_sold) as bigint) as total_units from demand "
       "group by date order by date limit 5", dates="date")
def o03(spark, sf):
    return daily_total(demand(spark, sf)).orderBy("date").limit(5)


@query("o03_last_row", TOTAL_DAILY + " select series_id, max(date) as date, arg_max(total_units, date) as total_units "
       "from daily group by series_id", dates="date")
def o03_last(spark, sf):
    return total_daily(spark, sf).groupBy("series_id").agg(
        F.max("date").alias("date"), F.max_by("total_units", "date").alias("total_units"))


@query("o04_sample_per_sku", """with rows as (
  select p_brand as sku_id, l_orderkey, l_linenumber, l_extendedprice / l_quantity as price,
         cast(l_quantity as bigint) as units_sold,
         md5(concat_ws('|', '0', cast(l_orderkey as varchar), cast(l_linenumber as varchar))) as h
  from lineitem join part on l_partkey = p_partkey)
select sku_id, l_orderkey, l_linenumber, price, units_sold from rows
qualify row_number() over (partition by sku_id order by h, sku_id, l_orderkey, l_linenumber, price, units_sold) <= 1000""",
       floats="price", digits=9)
def o04(spark, sf):
    rows = with_brand(spark, sf).select(
        F.col("p_brand").alias("sku_id"), "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("bigint").alias("units_sold"))
    return eda.sample_per_sku(rows, ["l_orderkey", "l_linenumber"])
