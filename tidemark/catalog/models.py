"""Fitted models. Recursions, an autoregressive candidate, its coefficient table and the key sets of forecasts have
SQL counterparts; fits by search and trees are checked by tests of recovery."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog.base import DEMAND, PART_DEMAND, SKU_DAILY, TOTAL_DAILY, daily_sql, demand, part_demand, query, sku_daily, total_daily
from tidemark.catalog.joins import BRIDGE
from tidemark.operators import linear as ln
from tidemark.operators import nonlinear as nl
from tidemark.operators.align import residuals
from tidemark.operators.eda import split_by_date
from tidemark.operators.evaluate import long_scores, model_metrics
from tidemark.operators.features import feature_columns, fit_minmax
from tidemark.operators.series import daily_series
from tidemark.operators.trees import NODE_COLUMNS
from tidemark.operators.stationarity import diagnostics, effective_sample
from tidemark.plans.forecast import forecast_rows, forecast_total
from tidemark.plans.train import MODELS, Settings, backtest_one_step, longest, train_hybrid, train_with_regressors
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.registry import save_table

SPLIT, AS_OF = "2001-07-01", "2001-12-15"
QUARTERS = 4


def split(daily: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_by_date(daily, SPLIT)


_TRAINED: dict[tuple[str, str], str] = {}


def trained(spark: SparkSession, sf: str) -> str:
    """Train once per application and table folder; the models live in the shared folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        folder = f"{ensure_checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"
        train_hybrid(*split(total_daily(spark, sf)), folder)
        _TRAINED[key] = folder
    return _TRAINED[key]


@query("m01_search_orders", digits=2)
def m01(spark, sf):
    return ln.search_orders(sku_daily(spark, sf)).select(
        "series_id", "d", "sd", "p", "q", "sp", "sq", "n", "aic", "admissible", "fallback")


# A first-order autoregression of the level, on the days that every candidate is compared on.
AR1 = SKU_DAILY + f""", x as (select series_id, cast(total_units as double) as y,
  cast(lag(total_units) over (partition by series_id order by date) as double) as x,
  row_number() over (partition by series_id order by date) as t from daily),
r as (select series_id, count(*) as n, regr_slope(y, x) as slope, regr_intercept(y, x) as intercept,
  regr_syy(y, x) - regr_sxy(y, x) ** 2 / regr_sxx(y, x) as sse, regr_sxx(y, x) as sxx, avg(x) as mean_x
  from x where t > {ln.Grid().start_up} group by series_id)"""


@query("m01_autoregressive_candidate", AR1 + """ select series_id, n, slope as ar1, intercept, sse,
  n * ln(sse / n) + 2 * 3 as aic from r where abs(slope) < 1""", floats="ar1 intercept sse aic", digits=4)
def m01_candidate(spark, sf):
    """One given order among all candidates: coefficients, residual sum and criterion."""
    return _first_order(sku_daily(spark, sf)).select(
        "series_id", "n", F.col("ar")[0].alias("ar1"), "intercept", "sse", "aic")


def _first_order(daily):
    return ln.candidate_models(daily).filter("d = 0 and sd = 0 and p = 1 and q = 0 and sp = 0 and sq = 0")


@query("m03_coefficient_table", AR1 + """, s as (select *, sse / n as sigma2 from r where abs(slope) < 1),
terms as (
  select series_id, 'intercept' as term, intercept as estimate, sqrt(sigma2 * (1.0 / n + mean_x ** 2 / sxx)) as std_error from s
  union all select series_id, 'ar.L1', slope, sqrt(sigma2 / sxx) from s
  union all select series_id, 'sigma2', sigma2, sigma2 * sqrt(2.0 / n) from s)
select *, estimate / std_error as z, estimate - 1.959963984540054 * std_error as low,
  estimate + 1.959963984540054 * std_error as high from terms""", floats="estimate std_error z low high", digits=3)
def m03_table(spark, sf):
    daily = sku_daily(spark, sf)
    given = _first_order(daily).withColumn("fallback", F.lit(False))
    return ln.coefficient_table(daily, given).drop("p_value")


@query("m02_search_plain_orders", digits=2)
def m02(spark, sf):
    return ln.search_orders(sku_daily(spark, sf), grid=ln.Grid.plain()).select(
        "series_id", "d", "p", "q", "n", "aic", "admissible")


@query("m03_fit_linear_regressors", digits=3)
def m03(spark, sf):
    coefficients, _ = train_with_regressors(*split(sku_daily(spark, sf)))
    return coefficients.select("series_id", "d", "sd", "p", "q", "sp", "sq", "aic", "intercept",
                               F.posexplode("beta").alias("regressor", "beta"))


@query("m04_forecast_linear", digits=3)
def m04(spark, sf):
    train, test = split(sku_daily(spark, sf))
    return ln.forecast_linear(train, ln.search_orders(train), test)


@query("m04_forecast_linear_parts", f"""with {PART_DEMAND},\n{daily_sql(by='sku_id')},
ends as (select max(date) as hi from daily)
select series_id, count(*) as days, min(date) as first_day, max(date) as last_day, count(*) as predicted
from daily where date >= date '{SPLIT}' and series_id in (select series_id from daily where date < date '{SPLIT}')
group by series_id""", dates="first_day last_day")
def m04_parts(spark, sf):
    """A catalog of many short series: a forecast for every product and test day, whatever the product's history."""
    # Fit, forecast and the list of series read the days; the observed ones are made once.
    folder = f"{ensure_checkpoint_dir(spark)}/part-days-{uuid.uuid4().hex}"
    daily = daily_series(part_demand(spark, sf), "sku_id", lambda observed: save_table(observed, folder))
    train, test = split(daily.select("series_id", "date", "total_units"))
    forecast = ln.forecast_linear(train, ln.search_orders(train), test)
    per_series = forecast.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.count("predicted_units").alias("predicted"))
    # A product without history has no forecast: the rows of the result are joined, not its days.
    return per_series.join(train.select("series_id").distinct(), "series_id")


@query("m05_apply_linear", digits=3)
def m05(spark, sf):
    daily = sku_daily(spark, sf)
    return ln.apply_linear(daily, ln.search_orders(split(daily)[0]))


@query("t05_linear_diagnostics", digits=3)
def t05_linear(spark, sf):
    daily = sku_daily(spark, sf)
    coefficients = ln.search_orders(daily)
    known = residuals(daily, ln.apply_linear(daily, coefficients))
    return diagnostics(effective_sample(known, coefficients), F.col("n_params"))


GIVEN = {"d": "1", "sd": "1", "intercept": "0D", "beta": "cast(array() as array<double>)",
         "ar": "array(0.3D, 0D, 0D, 0D, 0D, 0D, 0D)", "ma": "array(-0.4D, 0D, 0D, 0D, 0D, 0D, -0.3D)"}


@query("m05_apply_given_coefficients", f"""{SKU_DAILY.replace("with demand", "with recursive demand", 1)},
w as (select series_id, total_units as x, date, row_number() over s as i,
  cast(total_units - lag(total_units, 1) over s - lag(total_units, 7) over s + lag(total_units, 8) over s as double) as w
  from daily window s as (partition by series_id order by date)),
rec as (
  select series_id, 8 as i, 0.0::double as w, [0, 0, 0, 0, 0, 0, 0]::double[] as e from (select distinct series_id from w)
  union all
  select rec.series_id, rec.i + 1, n.w,
    list_append(rec.e[2:7], n.w - (0.3 * rec.w - 0.4 * rec.e[7] - 0.3 * rec.e[1]))
  from rec join w n on n.series_id = rec.series_id and n.i = rec.i + 1)
select w.series_id, w.date, w.x - rec.e[7] as fitted from w left join rec
  on rec.series_id = w.series_id and rec.i = w.i and w.i > 8""", dates="date", floats="fitted", digits=5)
def m05_given(spark, sf):
    """The residual recursion alone, with coefficients that are not fitted."""
    daily = sku_daily(spark, sf)
    return ln.apply_linear(daily, _given(daily))


@query("m04_forecast_given_coefficients", f"""{SKU_DAILY.replace("with demand", "with recursive demand", 1)},
w as (select series_id, date, total_units as x, row_number() over s as i, count(*) over (partition by series_id) as n,
  cast(total_units - lag(total_units, 1) over s - lag(total_units, 7) over s + lag(total_units, 8) over s as double) as w
  from daily where date < date '{SPLIT}' window s as (partition by series_id order by date)),
known as (select series_id, max(n) as n, max(date) as last, list(cast(x as double) order by i)[-8:] as x from w group by series_id),
rec as (
  select series_id, 8 as i, 0.0::double as w, [0, 0, 0, 0, 0, 0, 0]::double[] as e from known
  union all
  select rec.series_id, rec.i + 1, n.w, list_append(rec.e[2:7], n.w - (0.3 * rec.w - 0.4 * rec.e[7] - 0.3 * rec.e[1]))
  from rec join w n on n.series_id = rec.series_id and n.i = rec.i + 1),
ahead as (
  select known.series_id, 0 as k, known.last as date, known.x, rec.w, rec.e from known join rec
    on rec.series_id = known.series_id and rec.i = known.n
  union all
  select series_id, k + 1, cast(date + interval 1 day as date),
    list_append(x[2:8], x[8] + x[2] - x[1] + (0.3 * w - 0.4 * e[7] - 0.3 * e[1])),
    0.3 * w - 0.4 * e[7] - 0.3 * e[1], list_append(e[2:7], 0.0)
  from ahead where k < 120)
select series_id, date, x[8] as predicted_units from ahead where k > 0""", dates="date", floats="predicted_units", digits=4)
def m04_given(spark, sf):
    """120 days past the end of the training days, with coefficients that are not fitted."""
    train, _ = split(sku_daily(spark, sf))
    ends = train.groupBy("series_id").agg(F.max("date").alias("hi"))
    future = ends.select("series_id", F.explode(F.sequence(F.date_add("hi", 1), F.date_add("hi", 120))).alias("date"))
    return ln.forecast_linear(train, _given(train), future)


def _given(daily):
    return daily.select("series_id").distinct().selectExpr("series_id", *[f"{value} as {name}" for name, value in GIVEN.items()])


@query("m06_fit_nonlinear", digits=3)
def m06(spark, sf):
    """Test error of each output step of the trees, trained on the pooled brands."""
    train, test = split(sku_daily(spark, sf))
    model = nl.fit_nonlinear(train, "total_units")
    predicted = nl.predict_one_step(model, test)
    return model_metrics(test.select("series_id", "date", F.col("total_units").alias("actual")).join(
        predicted.withColumnRenamed("predicted_units", "predicted"), ["series_id", "date"]), ("series_id",))


@query("m07_forecast_blocks", digits=3)
def m07(spark, sf):
    folder = trained(spark, sf)
    return spark.read.parquet(f"{folder}/series/forecasts").select("series_id", "date", "nonlinear_only")


@query("m08_predict_one_step")
def m08(spark, sf):
    return backtest_one_step(demand(spark, sf), trained(spark, sf))


@query("m09_forecast_future_residual", digits=3)
def m09(spark, sf):
    folder = trained(spark, sf)
    daily = total_daily(spark, sf)
    known = residuals(daily, ln.apply_linear(daily, spark.read.parquet(f"{folder}/linear")))
    return nl.forecast_future(nl.NonlinearModel.load(spark, f"{folder}/nonlinear", "residuals"), known, 91 * QUARTERS)


# A small given model: step k looks at the same weekday of last week, at yesterday, its price and its promotion.
LAST_WEEK, YESTERDAY, PRICE, PROMO = 0.3512345, 0.5012345, 0.4912345, 0.5


def given_trees(target: str, train: DataFrame) -> nl.NonlinearModel:
    """Three trees a step that are not fitted, with the scaler of the training days."""
    columns = feature_columns(target)

    def feature(day: int, column: str) -> int:
        return day * len(columns) + columns.index(column)

    rows = []
    for k in range(nl.N_OUT):
        last = nl.N_IN - 1
        rows += [(k, 0, 1.0, 0, feature(last - 6 + k, target), LAST_WEEK, 1, 2, 0.0), (k, 0, 1.0, 1, -1, 0.0, 1, 1, 0.28),
                 (k, 0, 1.0, 2, feature(last, target), YESTERDAY, 3, 4, 0.0), (k, 0, 1.0, 3, -1, 0.0, 3, 3, 0.42),
                 (k, 0, 1.0, 4, -1, 0.0, 4, 4, 0.55),
                 (k, 1, 0.5, 0, feature(last, "avg_price"), PRICE, 1, 2, 0.0), (k, 1, 0.5, 1, -1, 0.0, 1, 1, -0.06),
                 (k, 1, 0.5, 2, -1, 0.0, 2, 2, 0.06),
                 (k, 2, 0.25, 0, feature(last, "promo_any"), PROMO, 1, 2, 0.0), (k, 2, 0.25, 1, -1, 0.0, 1, 1, 0.04 * (k + 1)),
                 (k, 2, 0.25, 2, -1, 0.0, 2, 2, -0.04)]
    return nl.NonlinearModel(target, pd.DataFrame(rows, columns=NODE_COLUMNS), fit_minmax(train, columns))


def _guess(k: str, x: str, price: str, promo: str) -> str:
    """The given trees of step ``k`` in SQL; ``x`` is the list of the last 30 scaled targets."""
    return f"""(case when {x}[24 + {k}] <= {LAST_WEEK} then 0.28 when {x}[30] <= {YESTERDAY} then 0.42 else 0.55 end
  + 0.5 * case when {price} <= {PRICE} then -0.06 else 0.06 end
  + 0.25 * case when {promo} <= {PROMO} then 0.04 * ({k} + 1) else -0.04 end)"""


def _scaling(known: str, target: str = "total_units", limited_by: str | None = None) -> str:
    """Views of the scaled days: ``lim`` has the limits of each series over the view ``limited_by`` (or ``known``)."""
    def scaled(column: str, out: str) -> str:
        return f"(cast({column} as double) - {out}_lo) / {out}_by as {out}"

    limits = ", ".join(f"""cast(min({c}) as double) as {o}_lo,
  case when max({c}) > min({c}) then cast(max({c}) - min({c}) as double) else 1.0 end as {o}_by"""
                       for c, o in ((target, "y"), ("avg_price", "price"), ("promo_any", "promo")))
    return f"""lim as (select series_id, {limits} from {limited_by or known} group by series_id),
scaled as (select series_id, date, {scaled(target, "y")}, {scaled("avg_price", "price")}, {scaled("promo_any", "promo")}, y_lo, y_by,
  row_number() over (partition by series_id order by date) as i from {known} join lim using (series_id)),
seed as (select series_id, max(date) as hi, list(y order by i)[-30:] as x, arg_max(price, i) as price, arg_max(promo, i) as promo,
  count(*) as n from scaled group by series_id)"""


RECURSIVE = SKU_DAILY.replace("with demand", "with recursive demand", 1)
BLOCKS = f"""list_transform(range(0, 7), lambda k: {_guess("k", "x", "price", "promo")})"""


@query("m08_predict_one_step_given_trees", f"""{SKU_DAILY}, {_scaling("daily")},
w as (select *, list(y) over s as x, lag(price) over o as price_1, lag(promo) over o as promo_1 from scaled
  window s as (partition by series_id order by date rows between 30 preceding and 1 preceding), o as (partition by series_id order by date))
select series_id, date, y_lo + y_by * {_guess("0", "x", "price_1", "promo_1")} as predicted_units from w where len(x) = 30""",
       dates="date", floats="predicted_units", digits=4)
def m08_given(spark, sf):
    """One-step predictions of every brand and day by trees that are not fitted."""
    daily = sku_daily(spark, sf)
    return nl.predict_one_step(given_trees("total_units", daily), daily)


@query("m07_forecast_blocks_given_trees", f"""{RECURSIVE}, train as (select * from daily where date < date '{SPLIT}'),
{_scaling("train")},
test as (select series_id, date, (avg_price - price_lo) / price_by as price, (promo_any - promo_lo) / promo_by as promo,
  row_number() over (partition by series_id order by date) as i from daily join lim using (series_id) where date >= date '{SPLIT}'),
rec as (
  select series_id, 0 as b, x, {BLOCKS} as y from seed where n >= 30
  union all
  select series_id, b + 1, x, {BLOCKS} from (select rec.series_id, b, list_concat(rec.x, rec.y)[-30:] as x, test.price, test.promo
    from rec join test on test.series_id = rec.series_id and test.i = 7 * (b + 1)) as moved)
select series_id, date, y_lo + y_by * y[(i - 1) % 7 + 1] as predicted_units
from test join rec using (series_id) join lim using (series_id) where b = (i - 1) // 7""", dates="date", floats="predicted_units", digits=4)
def m07_given(spark, sf):
    """The test days of every brand, block after block, by trees that are not fitted."""
    train, test = split(sku_daily(spark, sf))
    return nl.forecast_blocks(given_trees("total_units", train), train, test)


def _future_blocks(known: str) -> str:
    """The coming blocks of the given trees past the end of the view ``known``, with assumed regressors."""
    return f"""coming as (select series_id, (cast(avg(promo) > 0.5 as integer) - promo_lo) / promo_by as later from (
  select series_id, date, promo_any as promo, row_number() over (partition by series_id order by date desc) as r from {known}) as d
  join lim using (series_id) where r <= 30 group by series_id, promo_lo, promo_by),
rec as (
  select series_id, 0 as b, x, price, {BLOCKS} as y from seed where n >= 30
  union all
  select series_id, b + 1, x, price, {BLOCKS} from (select rec.series_id, b, list_concat(rec.x, rec.y)[-30:] as x, price, later as promo
    from rec join coming using (series_id) where b < {13 * QUARTERS - 1}) as moved),
blocks as (select series_id, cast(hi + cast(7 * b + k as integer) as date) as date, y_lo + y_by * rec.y[k] as predicted_units
  from rec join (select series_id, hi from seed) as s using (series_id) join lim using (series_id), range(1, 8) as r(k))"""


@query("m09_forecast_future_given_trees", f"""{RECURSIVE}, {_scaling("daily")},
{_future_blocks("daily")} select * from blocks""", dates="date", floats="predicted_units", digits=4)
def m09_given(spark, sf):
    """Four quarters past the end of every brand by trees that are not fitted."""
    daily = sku_daily(spark, sf)
    return nl.forecast_future(given_trees("total_units", daily), daily, 91 * QUARTERS)


@query("m12_forecast_total_given_models", f"""{TOTAL_DAILY.replace("with demand", "with recursive demand", 1)}, {BRIDGE},
whole as (select series_id, date, total_units, avg_price, promo_any from daily union all select * from bridge),
w as (select *, cast(total_units as double) as x, row_number() over s as i, cast(total_units - lag(total_units, 1) over s
  - lag(total_units, 7) over s + lag(total_units, 8) over s as double) as w from whole window s as (partition by series_id order by date)),
last_days as (select series_id, max(i) as n, max(date) as last, list(x order by i)[-8:] as x from w group by series_id),
fit as (
  select series_id, 8 as i, 0.0::double as w, [0, 0, 0, 0, 0, 0, 0]::double[] as e from last_days
  union all
  select fit.series_id, fit.i + 1, n.w, list_append(fit.e[2:7], n.w - (0.3 * fit.w - 0.4 * fit.e[7] - 0.3 * fit.e[1]))
  from fit join w n on n.series_id = fit.series_id and n.i = fit.i + 1),
ahead as (
  select d.series_id, 0 as k, d.last as date, d.x, fit.w, fit.e from last_days d join fit on fit.series_id = d.series_id and fit.i = d.n
  union all
  select series_id, k + 1, cast(date + interval 1 day as date), list_append(x[2:8], x[8] + x[2] - x[1] + (0.3 * w - 0.4 * e[7] - 0.3 * e[1])),
    0.3 * w - 0.4 * e[7] - 0.3 * e[1], list_append(e[2:7], 0.0) from ahead where k < {91 * QUARTERS}),
known as (select w.series_id, w.date, avg_price, promo_any, case when w.i > 8 then fit.e[7] else 0.0 end as residuals
  from w left join fit on fit.series_id = w.series_id and fit.i = w.i),
history as (select known.* from known join daily using (series_id, date)),
{_scaling("known", "residuals", "history")},
{_future_blocks("known")}
select a.series_id, a.date, a.x[8] + b.predicted_units as predicted_units from ahead a join blocks b
  on b.series_id = a.series_id and b.date = a.date where a.k > 0 and a.date >= date_trunc('month', date '{AS_OF}') + interval 1 month""",
       dates="date", floats="predicted_units", digits=3)
def m12_given(spark, sf):
    """The whole forecast of the total by stored models that are not fitted: bridged days, recursion, residual blocks, sum."""
    daily = total_daily(spark, sf)
    folder = f"{ensure_checkpoint_dir(spark)}/given-{uuid.uuid4().hex}"
    coefficients = save_table(_given(daily), f"{folder}/linear")
    given_trees("residuals", residuals(daily, ln.apply_linear(daily, coefficients))).save(f"{folder}/nonlinear")
    return forecast_total(daily, folder, QUARTERS, AS_OF)


@query("m11_hybrid", digits=3)
def m11(spark, sf):
    forecasts = spark.read.parquet(f"{trained(spark, sf)}/series/forecasts")
    return model_metrics(long_scores(forecasts, MODELS))


@query("m12_run_forecast")
def m12(spark, sf):
    return _forecast(spark, sf).sku_daily


def _forecast(spark, sf):
    return forecast_rows(demand(spark, sf), QUARTERS, AS_OF, trained(spark, sf))


# Days of the forecast: the quarters' days less those before the first full month.
HORIZON = f"""horizon as (select cast(unnest(generate_series(first_day, last_day, interval 1 day)) as date) as date from (
  select cast(date_trunc('month', date '{AS_OF}') + interval 1 month as date) as first_day,
    greatest(max(date), date '{AS_OF}' - 1) + {91 * QUARTERS} as last_day from demand))"""


@query("m12_run_forecast_keys", f"""with {DEMAND}, {HORIZON} select sku_id, count(*) as days, min(date) as first_day,
  max(date) as last_day, true as positive from horizon, (select distinct sku_id from demand) group by sku_id""",
       dates="first_day last_day")
def m12_keys(spark, sf):
    return _forecast(spark, sf).sku_daily.groupBy("sku_id").agg(
        F.count(F.lit(1)).alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.bool_and(F.col("predicted_units") >= 0).alias("positive"))


@query("m12_run_forecast_quarterly")
def m12_quarterly(spark, sf):
    return _forecast(spark, sf).sku_quarterly
