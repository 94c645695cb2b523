"""Joins of series and the forecast calendar."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidemark.catalog.base import (BRANDS, DEMAND, FORECAST, ORDER_DAYS, PART_DEMAND, SKU_DAILY, TOTAL_DAILY, daily_sql,
                                   demand, order_days, part_demand, query, sku_daily, sku_forecast, total_daily)
from tidemark.operators import align as al
from tidemark.operators import horizon as hz
from tidemark.operators import report as rp
from tidemark.operators.series import daily_series

AS_OF = "2001-12-15"
W = "partition by series_id order by date"


def naive_forecasts(daily):
    """Forecast columns that need no fitted model: last week, trailing week mean, their mean."""
    w = Window.partitionBy("series_id").orderBy("date")
    weekly = F.lag("total_units", 7).over(w).cast("double")
    recent = F.avg("total_units").over(w.rowsBetween(-7, -1))
    return daily.select("series_id", "date", "total_units", weekly.alias("weekly"), recent.alias("recent")) \
        .filter("weekly is not null").withColumn("mixed", (F.col("weekly") + F.col("recent")) / 2)


NAIVE = f""", naive as (select series_id, date, total_units,
  cast(lag(total_units, 7) over ({W}) as double) as weekly,
  avg(total_units) over ({W} rows between 7 preceding and 1 preceding) as recent
  from daily qualify lag(total_units, 7) over ({W}) is not null),
scored as (select *, (weekly + recent) / 2 as mixed from naive)"""


@query("j01_densify_calendar", SKU_DAILY + " select series_id, date, total_units, promo_any from daily", dates="date")
def j01(spark, sf):
    return sku_daily(spark, sf).select("series_id", "date", "total_units", "promo_any")


@query("j02_align", SKU_DAILY + NAIVE + " select series_id, date, total_units, weekly as predicted_units from scored",
       dates="date", floats="predicted_units")
def j02(spark, sf):
    daily = sku_daily(spark, sf).select("series_id", "date", "total_units")
    forecast = naive_forecasts(daily).select("series_id", "date", F.col("weekly").alias("predicted_units"))
    return al.align(daily, forecast)


BRIDGE = f"""ends as (select series_id, min(date) as lo, max(date) as hi from daily group by series_id),
gap as (select series_id, lo, hi, cast(unnest(generate_series(hi + interval 1 day, date '{AS_OF}' - interval 1 day,
  interval 1 day)) as date) as day from ends),
bridge as (select g.series_id, g.day as date, d.total_units, d.avg_price, d.promo_any from gap g join daily d
  on d.series_id = g.series_id and d.date = least(greatest(cast(g.day - interval 1 year as date), g.lo), g.hi))"""


@query("j03_bridge_days", SKU_DAILY + f",\n{BRIDGE} select * from bridge", dates="date", floats="avg_price")
def j03(spark, sf):
    return hz.bridge_days(sku_daily(spark, sf), AS_OF)


@query("u01_bridge_gap", TOTAL_DAILY + f""",\n{BRIDGE}, whole as (
  select series_id, date, total_units, avg_price, promo_any from daily union all select * from bridge)
select *, cast((dayofweek(date) + 6) % 7 as integer) as dow,
  sin(2 * pi() * ((dayofweek(date) + 6) % 7) / 7) as dow_sin, cos(2 * pi() * ((dayofweek(date) + 6) % 7) / 7) as dow_cos,
  sin(2 * pi() * dayofyear(date) / 365.25) as doy_sin, cos(2 * pi() * dayofyear(date) / 365.25) as doy_cos from whole""",
       dates="date", floats="avg_price dow_sin dow_cos doy_sin doy_cos")
def u01(spark, sf):
    return hz.bridge_gap(total_daily(spark, sf), AS_OF)


SHARES = """cut as (select max(date) - interval 28 day as cut from demand),
sums as (select sku_id, coalesce(sum(units_sold) filter (where date > cut), 0) as recent, sum(units_sold) as ever
         from demand, cut group by sku_id),
shares as (select sku_id, case when sum(recent) over () > 0 then recent / sum(recent) over ()
                    when sum(ever) over () > 0 then ever / sum(ever) over () else 1.0 / count(*) over () end as share
           from sums)"""


@query("j04_allocate", TOTAL_DAILY + f""",\n{SHARES}
select sku_id, date, total_units * share as predicted_units from daily, shares""", dates="date", floats="predicted_units")
def j04(spark, sf):
    total = total_daily(spark, sf).select(
        "date", F.col("total_units").cast("double").alias("predicted_units"))
    return hz.allocate(total, hz.sku_shares(demand(spark, sf)))


@query("j05_missing_regressors", f"""with {ORDER_DAYS},\n{daily_sql()}, future as (
  select cast(unnest(generate_series(min(date), max(date) + interval 10 day, interval 1 day)) as date) as date from daily)
select 'ALL' as series_id, date from future where date not in (select date from demand)""", dates="date")
def j05(spark, sf):
    observed = order_days(spark, sf).select(F.lit("ALL").alias("series_id"), "date").distinct()
    ends = observed.groupBy("series_id").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    days = ends.select("series_id", F.explode(F.sequence("lo", F.date_add("hi", 10))).alias("date"))
    return al.missing_regressors(days, observed)


_BRAND_MAX = ", ".join(f"max(v) filter (where sku_id = '{b}') as \"{b}\"" for b in BRANDS)


@query("j06_comparison_matrix", FORECAST + f""", m as (select sku_id, date, coalesce(
  avg(predicted_units) over (partition by sku_id order by date rows between 7 preceding and 6 following),
  predicted_units) as v from forecast)
select date, {_BRAND_MAX} from m group by date""", dates="date", floats=" ".join(BRANDS))
def j06(spark, sf):
    return rp.comparison_matrix(rp.centred_averages(sku_forecast(spark, sf)))


@query("j07_hybrid_sum", SKU_DAILY + NAIVE + " select series_id, date, weekly + recent as predicted_units from scored",
       dates="date", floats="predicted_units")
def j07(spark, sf):
    scored = naive_forecasts(sku_daily(spark, sf))
    return al.hybrid_sum(scored.select("series_id", "date", F.col("weekly").alias("predicted_units")),
                         scored.select("series_id", "date", F.col("recent").alias("predicted_units")))


@query("j08_residuals", SKU_DAILY + f""" select series_id, date, total_units,
  coalesce(total_units - lag(total_units, 7) over ({W}), 0.0) as residuals from daily""", dates="date", floats="residuals")
def j08(spark, sf):
    daily = sku_daily(spark, sf).select("series_id", "date", "total_units")
    return al.residuals(daily, naive_forecasts(daily).withColumnRenamed("weekly", "fitted"))


@query("m10_plan_horizon", f"""with {DEMAND}, ends as (select sku_id, max(date) as last_date from demand group by sku_id),
asked as (select sku_id, last_date, quarters, as_of from ends, (select unnest(range(1, 9)) as quarters),
  (select unnest([date '2001-12-15', date '2002-01-02', date '2002-01-28', date '2001-06-30']) as as_of)),
b as (select *, greatest(date_diff('day', last_date, as_of) - 1, 0) as bridged_days,
        greatest(last_date, as_of - 1) as bridged_to, quarters * 91 as total_days,
        cast(date_trunc('month', as_of) + interval 1 month as date) as next_month from asked),
s as (select *, case when day(as_of) < 28 and date_diff('day', bridged_to, next_month) - 1 > 0
   and date_diff('day', bridged_to, next_month) - 1 < total_days
   then date_diff('day', bridged_to, next_month) - 1 else 0 end as days_to_skip from b)
select sku_id, last_date, cast(quarters as integer) as quarters, as_of, cast(bridged_days as integer) as bridged_days,
  bridged_to, cast(total_days as integer) as total_days, cast(days_to_skip as integer) as days_to_skip,
  cast(total_days - days_to_skip as integer) as forecast_days,
  cast(bridged_to + cast(days_to_skip + 1 as integer) as date) as first_label from s""",
       dates="last_date as_of bridged_to first_label")
def m10(spark, sf):
    ends = demand(spark, sf).groupBy("sku_id").agg(F.max("date").alias("last_date"))
    days = ["2001-12-15", "2002-01-02", "2002-01-28", "2001-06-30"]
    asked = ends.withColumn("quarters", F.explode(F.sequence(F.lit(1), F.lit(8)))).withColumn(
        "as_of", F.explode(F.array(*[F.lit(d).cast("date") for d in days])))
    return hz.plan_horizon(asked, F.col("as_of"), F.col("quarters"))
