"""Accuracy of forecasts. The scored models are rules (last week, trailing week, their mean), so
no fit is needed; each brand counts as one run."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import DEMAND, SKU_DAILY, TOTAL_DAILY, query, sku_daily, total_daily, variants
from tidemark.catalog.joins import NAIVE, naive_forecasts
from tidemark.operators import evaluate as ev
from tidemark.operators.series import daily_series
from tidemark.sources.registry import latest_run

MODELS = ["weekly", "recent", "mixed"]
LONG = """, long as (unpivot (select series_id, date, cast(total_units as double) as actual, weekly, recent, mixed
  from scored) on weekly, recent, mixed into name model value predicted),
metrics as (select series_id as run_id, model, sqrt(avg((actual - predicted) ** 2)) as rmse,
  avg(abs(actual - predicted) / (abs(actual) + 1e-8)) * 100 as mape from long group by series_id, model)"""


def scored(daily):
    return ev.long_scores(naive_forecasts(daily), MODELS)


def run_metrics(spark, sf):
    return ev.model_metrics(scored(sku_daily(spark, sf)), ("series_id", "model")).withColumnRenamed("series_id", "run_id")


@query("e01_rmse", TOTAL_DAILY + NAIVE + " select sqrt(avg((total_units - weekly) ** 2)) as rmse from scored",
       floats="rmse", digits=4)
def e01(spark, sf):
    return naive_forecasts(total_daily(spark, sf)).select(
        F.col("total_units").alias("actual"), F.col("weekly").alias("predicted")).agg(ev.rmse())


@query("e02_mape", TOTAL_DAILY + NAIVE + " select avg(abs(total_units - weekly) / (abs(total_units) + 1e-8)) * 100 "
       "as mape from scored", floats="mape", digits=4)
def e02(spark, sf):
    return naive_forecasts(total_daily(spark, sf)).select(
        F.col("total_units").alias("actual"), F.col("weekly").alias("predicted")).agg(ev.mape())


@query("e03_model_metrics", TOTAL_DAILY + NAIVE + LONG + " select model, rmse, mape from metrics",
       floats="rmse mape", digits=4)
def e03(spark, sf):
    return ev.model_metrics(scored(total_daily(spark, sf)))


@query("e03_model_metrics_per_sku", SKU_DAILY + NAIVE + LONG + " select run_id, model, rmse, round(mape, 0) as mape from metrics",
       floats="rmse mape", digits=4)
def e03_sku(spark, sf):
    return run_metrics(spark, sf).withColumn("mape", F.round("mape", 0))


@query("e04_relative_scores", SKU_DAILY + NAIVE + LONG + """ select run_id, model,
  round_even(min(rmse) over (partition by run_id) / rmse * 100, 2) as rmse_score,
  round_even(min(mape) over (partition by run_id) / mape * 100, 2) as mape_score from metrics""",
       floats="rmse_score mape_score", digits=2)
def e04(spark, sf):
    return ev.relative_scores(run_metrics(spark, sf))


@query("e05_error_bars", SKU_DAILY + NAIVE + LONG + """, b as (select run_id, model,
  greatest(0.0, least(100.0, rmse / max(rmse) over (partition by run_id) * 100)) as rmse_bar,
  greatest(0.0, least(100.0, mape / max(mape) over (partition by run_id) * 100)) as mape_bar from metrics)
select run_id, model, rmse_bar, mape_bar,
  case when rmse_bar >= 75 then 'high' when rmse_bar >= 50 then 'middle' else 'low' end as rmse_band,
  case when mape_bar >= 75 then 'high' when mape_bar >= 50 then 'middle' else 'low' end as mape_band from b""",
       floats="rmse_bar mape_bar", digits=4)
def e05(spark, sf):
    return ev.error_bars(run_metrics(spark, sf)).drop("rmse", "mape")


# A day without units makes the percentage error explode, so it is compared in whole numbers.
RUNS = ", ".join(f"max({v}) filter (where run_id = '{r}') as {c}_{r}"
                 for c, v in (("rmse", "rmse"), ("mape", "round(mape, 0)")) for r in "ANR")
CHANGES = ", ".join(f"{c}_{r} - {c}_A as delta_{c}_{r}" for c in ("rmse", "mape") for r in "NR")


@query("e06_compare_runs", f"""with {DEMAND}, agg as (select variant, date, sum(units_sold) as u from demand group by all),
cal as (select variant, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
        from agg group by variant),
daily as (select variant as series_id, date, cast(coalesce(u, 0) as bigint) as total_units
          from cal left join agg using (variant, date)) {NAIVE} {LONG},
w as (select model, {RUNS} from metrics group by model)
select *, {CHANGES} from w""",
       floats=" ".join([f"{c}_{r}" for c in ("rmse", "mape") for r in "ANR"] + [f"delta_{c}_{r}" for c in ("rmse", "mape") for r in "NR"]),
       digits=4)
def e06(spark, sf):
    daily = daily_series(variants(spark, sf), "variant")
    metrics = ev.model_metrics(scored(daily), ("series_id", "model")).withColumnRenamed("series_id", "run_id")
    return ev.compare_runs(metrics.withColumn("mape", F.round("mape", 0)), ["A", "N", "R"])


@query("o02_leaderboard", SKU_DAILY + NAIVE + LONG + """ select run_id, model, rmse,
  cast(row_number() over (partition by run_id order by rmse, model) as integer) as rank from metrics""",
       floats="rmse", digits=4)
def o02(spark, sf):
    return ev.leaderboard(run_metrics(spark, sf)).drop("mape")


@query("a18_best_model", SKU_DAILY + NAIVE + LONG + """ select run_id, arg_min(model, rmse) as best_model,
  min(rmse) as lowest_rmse from metrics group by run_id""", floats="lowest_rmse", digits=4)
def a18(spark, sf):
    return ev.best_of(run_metrics(spark, sf)).drop("lowest_mape")


@query("s07_latest_run", SKU_DAILY + NAIVE + LONG + """, runs as (select run_id, max(last_day) as ts,
  max(rmse) filter (where model = 'weekly') as weekly_rmse, max(n) as train_size
  from metrics join (select series_id, max(date) as last_day, count(*) as n from daily group by series_id) d
  on d.series_id = run_id group by run_id)
select run_id, ts, weekly_rmse, train_size from runs order by ts desc, run_id desc limit 1""",
       dates="ts", floats="weekly_rmse", digits=4)
def s07(spark, sf):
    daily = sku_daily(spark, sf)
    days = daily.groupBy("series_id").agg(F.max("date").alias("ts"), F.count(F.lit(1)).alias("train_size"))
    weekly = run_metrics(spark, sf).filter(F.col("model") == "weekly")
    runs = weekly.join(days, weekly.run_id == days.series_id).select(
        "run_id", "ts", F.col("rmse").alias("weekly_rmse"), "train_size")
    return latest_run(runs)
