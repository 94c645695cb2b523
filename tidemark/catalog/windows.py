"""Ordered work on daily series: fills, averages, differences, model windows, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import (DEMAND, FORECAST, ORDER_DAYS, SKU_DAILY, TOTAL_DAILY, daily_sql, demand,
                                   order_days, query, sku_daily, sku_forecast, total_daily)
from tidemark.functions.calendar import calendar_features
from tidemark.operators import features as ft
from tidemark.operators import report as rp
from tidemark.operators import series as sr

W_SERIES = "partition by series_id order by date"
W_SKU = "partition by sku_id order by date"


@query("w01_fill_price", SKU_DAILY + " select series_id, date, avg_price from daily", dates="date", floats="avg_price")
def w01(spark, sf):
    dense = sr.densify_calendar(sr.daily_aggregate(sr.with_series(demand(spark, sf), "sku_id")))
    return sr.fill_price(dense).select("series_id", "date", "avg_price")


@query("w02_centred_week", TOTAL_DAILY + f" select series_id, date, avg(total_units) over ({W_SERIES} rows between 3 "
       "preceding and 3 following) as smooth from daily", dates="date", floats="smooth")
def w02(spark, sf):
    return rp.centred_smooth(total_daily(spark, sf), "total_units").select("series_id", "date", "smooth")


@query("w03_centred_averages", FORECAST + f""" select sku_id, date, predicted_units,
  avg(predicted_units) over ({W_SKU} rows between 3 preceding and 3 following) as ma7,
  avg(predicted_units) over ({W_SKU} rows between 7 preceding and 6 following) as ma14 from forecast""",
       dates="date", floats="predicted_units ma7 ma14")
def w03(spark, sf):
    return rp.centred_averages(sku_forecast(spark, sf))


@query("w04_total_with_averages", TOTAL_DAILY + f""" select series_id, date, total_units as predicted_units,
  round_even(avg(total_units) over ({W_SERIES} rows between 6 preceding and current row), 1) as ma7,
  round_even(avg(total_units) over ({W_SERIES} rows between 13 preceding and current row), 1) as ma14 from daily""",
       dates="date", floats="ma7 ma14")
def w04(spark, sf):
    total = total_daily(spark, sf).select("series_id", "date", F.col("total_units").cast("double").alias("predicted_units"))
    return rp.total_with_averages(total)


@query("w05_trailing_average", f"""with {DEMAND}, d as (select sku_id, date, cast(sum(units_sold) as bigint) as units
  from demand group by sku_id, date)
select sku_id, date, units, avg(units) over ({W_SKU} rows between 13 preceding and current row) as ma14 from d""",
       dates="date", floats="ma14")
def w05(spark, sf):
    return rp.trailing_average(demand(spark, sf))


@query("w06_first_difference", SKU_DAILY + f""" select series_id, date, total_units,
  total_units - lag(total_units) over ({W_SERIES}) as diff from daily
  qualify lag(total_units) over ({W_SERIES}) is not null""", dates="date")
def w06(spark, sf):
    return sr.first_difference(sku_daily(spark, sf).select("series_id", "date", "total_units"))


@query("w07_seasonal_difference", SKU_DAILY + f""" select series_id, date, total_units - lag(total_units, 1) over ({W_SERIES})
  - lag(total_units, 7) over ({W_SERIES}) + lag(total_units, 8) over ({W_SERIES}) as w from daily
  qualify lag(total_units, 8) over ({W_SERIES}) is not null""", dates="date", floats="w")
def w07(spark, sf):
    return sr.seasonal_difference(sku_daily(spark, sf)).select("series_id", "date", "w")


# All columns of the windows as whole millionths.
_MILLIONTHS = " || ':' || ".join(f"cast(floor({c} * 1000000 + 0.5) as bigint)" for c in ft.feature_columns())


@query("w08_supervised_windows", SKU_DAILY + f""", pairs as (select series_id, date,
  list({_MILLIONTHS}) over ({W_SERIES} rows between 30 preceding and 1 preceding) as x,
  list(total_units) over ({W_SERIES} rows between current row and 6 following) as y from daily)
select series_id, date, md5(array_to_string(x, ',')) as x, array_to_string(y, ',') as y from pairs
where len(x) = 30 and len(y) = 7""", dates="date")
def w08(spark, sf):
    pairs = ft.supervised_windows(sku_daily(spark, sf), ft.feature_columns())

    def millionths(v):
        return F.floor(v * 1000000 + 0.5).cast("string")

    days = F.transform("x", lambda d: F.array_join(F.transform(d, millionths), ":"))
    return pairs.select(
        "series_id", "date", F.md5(F.array_join(days, ",")).alias("x"),
        F.array_join(F.transform("y", lambda v: v.cast("bigint").cast("string")), ",").alias("y"))


@query("w09_validation_split", SKU_DAILY + f""", pairs as (select series_id, date,
  count(*) over ({W_SERIES} rows between 30 preceding and 1 preceding) as nx,
  count(*) over ({W_SERIES} rows between current row and 6 following) as ny from daily),
n as (select series_id, date, count(*) over (partition by series_id) as n, row_number() over ({W_SERIES}) as i
      from pairs where nx = 30 and ny = 7)
select series_id, n >= 20 and i > n - greatest(1, cast(floor(0.1 * n) as bigint)) as is_val, count(*) as windows,
       min(date) as first_day, max(date) as last_day from n group by all""", dates="first_day last_day")
def w09(spark, sf):
    split = ft.validation_split(ft.supervised_windows(sku_daily(spark, sf), ["total_units"]))
    return split.groupBy("series_id", "is_val").agg(
        F.count(F.lit(1)).alias("windows"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@query("w10_last_rows", SKU_DAILY + " select series_id, date, total_units from daily qualify row_number() over "
       "(partition by series_id order by date desc) <= 30", dates="date")
def w10(spark, sf):
    return ft.last_rows(sku_daily(spark, sf)).select("series_id", "date", "total_units")


SEED = SKU_DAILY + """, seed as (select * from daily qualify row_number() over
  (partition by series_id order by date desc) <= 30),
stats as (select series_id, max(date) as last_date, arg_max(avg_price, date) as last_price,
  avg(promo_any) as promo_mean, count(*) as n_seed from seed group by series_id)"""


@query("w11_seed_statistics", SEED + " select * from stats", dates="last_date", floats="last_price promo_mean")
def w11(spark, sf):
    return ft.seed_statistics(ft.last_rows(sku_daily(spark, sf)))


@query("f01_calendar_features", f"""with {ORDER_DAYS}, d as (select date, count(*) as n from demand group by date)
select date, n, cast((dayofweek(date) + 6) % 7 as integer) as dow,
  sin(2 * pi() * ((dayofweek(date) + 6) % 7) / 7) as dow_sin, cos(2 * pi() * ((dayofweek(date) + 6) % 7) / 7) as dow_cos,
  sin(2 * pi() * dayofyear(date) / 365.25) as doy_sin, cos(2 * pi() * dayofyear(date) / 365.25) as doy_cos from d""",
       dates="date", floats="dow_sin dow_cos doy_sin doy_cos")
def f01(spark, sf):
    return calendar_features(order_days(spark, sf).groupBy("date").agg(F.count(F.lit(1)).alias("n")))


@query("f02_future_features", SEED + """, future as (select series_id, last_price, promo_mean,
  cast(unnest(generate_series(last_date + interval 1 day, last_date + interval 91 day, interval 1 day)) as date) as date
  from stats)
select series_id, date, last_price as avg_price, case when promo_mean > 0.5 then 1 else 0 end as promo_any,
  cast((dayofweek(date) + 6) % 7 as integer) as dow,
  sin(2 * pi() * ((dayofweek(date) + 6) % 7) / 7) as dow_sin, cos(2 * pi() * ((dayofweek(date) + 6) % 7) / 7) as dow_cos,
  sin(2 * pi() * dayofyear(date) / 365.25) as doy_sin, cos(2 * pi() * dayofyear(date) / 365.25) as doy_cos from future""",
       dates="date", floats="avg_price dow_sin dow_cos doy_sin doy_cos")
def f02(spark, sf):
    return ft.future_features(ft.seed_statistics(ft.last_rows(sku_daily(spark, sf))), 91)


def _scaled_sql(shift: str, scale: str) -> str:
    cols = ["avg_price", "promo_any", "dow_sin", "doy_sin"]
    stats = ", ".join(f"{shift.format(c=c)} as {c}_a, {scale.format(c=c)} as {c}_b" for c in cols)
    out = ", ".join(f"({c} - {c}_a) / case when {c}_b > 0 then {c}_b else 1 end as {c}" for c in cols)
    return SKU_DAILY + f""", stats as (select series_id, {stats} from daily where date < date '2000-01-01' group by series_id)
select series_id, date, {out} from daily join stats using (series_id) where date >= date '2000-01-01'"""


@query("f03_standard_scaling", _scaled_sql("avg({c})", "stddev_pop({c})"), dates="date",
       floats="avg_price promo_any dow_sin doy_sin")
def f03(spark, sf):
    return _scaled(spark, sf, ft.fit_standard)


@query("f04_minmax_scaling", _scaled_sql("min({c})", "max({c}) - min({c})"), dates="date",
       floats="avg_price promo_any dow_sin doy_sin")
def f04(spark, sf):
    return _scaled(spark, sf, ft.fit_minmax)


def _scaled(spark, sf, fit):
    from tidemark.operators.eda import split_by_date

    cols = ["avg_price", "promo_any", "dow_sin", "doy_sin"]
    train, test = split_by_date(sku_daily(spark, sf).select("series_id", "date", *cols), "2000-01-01")
    return ft.apply_scaler(test, fit(train, cols), cols)


@query("f04_minmax_inverse", SKU_DAILY + " select series_id, date, cast(total_units as double) as total_units from daily",
       dates="date", floats="total_units")
def f04_inverse(spark, sf):
    daily = sku_daily(spark, sf).select("series_id", "date", "total_units")
    scaler = ft.fit_minmax(daily, ["total_units"])
    scaled = ft.apply_scaler(daily, scaler, ["total_units"])
    return scaled.join(scaler, "series_id").select(
        "series_id", "date", ft.invert_scaler(F.col("total_units"), "total_units").alias("total_units"))
