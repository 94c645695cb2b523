"""Rollups and views of forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import FORECAST, PART_DEMAND, daily_sql, part_demand, query, sku_forecast
from tidemark.operators import report as rp
from tidemark.operators.series import daily_series

AVERAGED = FORECAST + """, averaged as (select *,
  avg(predicted_units) over (partition by sku_id order by date rows between 3 preceding and 3 following) as ma7,
  avg(predicted_units) over (partition by sku_id order by date rows between 7 preceding and 6 following) as ma14
  from forecast)"""


@query("a09_quarterly_rollup", FORECAST + """ select sku_id, 'Q' || quarter(date) || ' ' || year(date) as quarter_label,
  cast(round_even(sum(predicted_units), 0) as bigint) as predicted_units, min(date) as start_date, max(date) as end_date
from forecast group by sku_id, year(date), quarter(date)""", dates="start_date end_date")
def a09(spark, sf):
    return rp.quarterly_rollup(sku_forecast(spark, sf))


@query("a10_monthly_rollup", FORECAST + " select sku_id, strftime(date, '%Y-%m') as month, "
       "sum(predicted_units) as predicted_units from forecast group by all", floats="predicted_units")
def a10(spark, sf):
    return rp.monthly_rollup(sku_forecast(spark, sf)).orderBy("sku_id", "month")


@query("a11_weekday_means", FORECAST + """, days as (select sku_id, unnest(range(0, 7)) as weekday
  from (select distinct sku_id from forecast)),
means as (select sku_id, (dayofweek(date) + 6) % 7 as weekday, avg(predicted_units) as m from forecast
          group by all)
select sku_id, cast(weekday as integer) as weekday, coalesce(m, 0.0) as mean_units
from days left join means using (sku_id, weekday)""", floats="mean_units")
def a11(spark, sf):
    return rp.weekday_means(sku_forecast(spark, sf))


def _histogram_sql(source: str) -> str:
    return source + """, r as (select sku_id, min(predicted_units) as lo,
  case when max(predicted_units) > min(predicted_units) then (max(predicted_units) - min(predicted_units)) / 15
       else 1.0 end as w from forecast group by sku_id),
c as (select f.sku_id, least(cast(floor((predicted_units - lo) / w) as integer), 14) as bin, count(*) as n
      from forecast f join r on r.sku_id = f.sku_id group by all),
b as (select sku_id, lo, w, unnest(range(0, 15)) as bin from r)
select sku_id, cast(bin as integer) as bin, cast(cast(floor(lo + bin * w + 0.5) as bigint) as varchar) || '-' ||
  cast(cast(floor(lo + bin * w + w + 0.5) as bigint) as varchar) as label, coalesce(n, 0) as n
from b left join c using (sku_id, bin)"""


@query("a12_histogram", _histogram_sql(FORECAST))
def a12(spark, sf):
    return rp.histogram(sku_forecast(spark, sf))


@query("a12_histogram_parts", _histogram_sql(f"with {PART_DEMAND},\n{daily_sql(by='sku_id')}" + """,
forecast as (select series_id as sku_id, date, cast(total_units as double) as predicted_units from daily)"""))
def a12_parts(spark, sf):
    daily = daily_series(part_demand(spark, sf), "sku_id")
    return rp.histogram(daily.select(F.col("series_id").alias("sku_id"), "date",
                                     F.col("total_units").cast("double").alias("predicted_units")))


@query("a13_summary_stats", FORECAST + """, d as (select date, sum(predicted_units) as units from forecast group by date)
select (select count(distinct sku_id) from forecast) as skus, avg(units) as mean_daily_units,
  '4 quarters (364 days)' as horizon from d""", floats="mean_daily_units")
def a13(spark, sf):
    return rp.summary_stats(sku_forecast(spark, sf), 4, 364)


@query("a15_downsample", AVERAGED + """, r as (select *, count(*) over (partition by sku_id) as n,
  row_number() over (partition by sku_id order by date) - 1 as i,
  cast(count(*) over (partition by sku_id) as double) / 500.0::double as step from averaged),
e as (select sku_id, n, step, unnest(range(0, 500)) as b from (select distinct sku_id, n, step from r where n > 500)),
edges as (select sku_id, b, cast(trunc(b * step) as bigint) as s, least(cast(trunc((b + 1) * step) as bigint), n) as t from e),
big as (select r.sku_id, b, s, t, i, date, predicted_units, ma7, ma14 from r join edges
        on r.sku_id = edges.sku_id and i >= s and i < t)
select sku_id, max(case when i = s + (t - s) // 2 then date end) as date, max(predicted_units) as predicted_units,
  case when count(*) = 1 then max(ma7) else round_even(avg(ma7), 1) end as ma7,
  case when count(*) = 1 then max(ma14) else round_even(avg(ma14), 1) end as ma14 from big group by sku_id, b
union all
select sku_id, date, predicted_units, ma7, ma14 from r where n <= 500""",
       dates="date", floats="predicted_units ma7 ma14")
def a15(spark, sf):
    return rp.downsample(rp.centred_averages(sku_forecast(spark, sf)))


@query("s06_forecast_export", AVERAGED + """ select strftime(date, '%Y-%m-%d') as "Date",
  cast(round_even(predicted_units, 0) as bigint) as "Predicted Units",
  printf('%.1f', round_even(ma7, 1)) as "MA7", printf('%.1f', round_even(ma14, 1)) as "MA14", sku_id as "SKU"
from averaged""")
def s06(spark, sf):
    from tidemark.sources.sinks import forecast_export

    return forecast_export(rp.rounded_forecast(rp.centred_averages(sku_forecast(spark, sf))))
