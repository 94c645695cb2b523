"""Time-series statistics."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidemark.catalog.base import SKU_DAILY, query, sku_daily
from tidemark.catalog.joins import NAIVE, naive_forecasts
from tidemark.operators import stationarity as st

LAGS = 40
ACF = SKU_DAILY + """, c as (select series_id, date, total_units - avg(total_units) over (partition by series_id) as c,
  row_number() over (partition by series_id order by date) as i from daily),
n as (select series_id, count(*) as n, sum(c * c) as v from c group by series_id),
lagged as (select a.series_id, k as lag, sum(a.c * b.c) as s from c a, range(0, 41) r(k), c b
  where b.series_id = a.series_id and b.i = a.i - k group by a.series_id, k),
acf as (select series_id, lag, s / v as acf, n from lagged join n using (series_id))"""


@query("t02_acf", ACF + """ select series_id, cast(lag as integer) as lag, acf, case when lag = 0 then 0.0 else
  1.959963984540054 * sqrt((1 + 2 * coalesce(sum(case when lag > 0 then acf * acf end) over
    (partition by series_id order by lag rows between unbounded preceding and 1 preceding), 0)) / n) end as band from acf""",
       floats="acf band")
def t02(spark, sf):
    return st.acf(sku_daily(spark, sf), max_lag=LAGS)


@query("t03_pacf", ACF.replace("with demand", "with recursive demand", 1) + """,
a as (select series_id, list(acf order by lag) as r, max(n) as n from acf group by series_id),
rec as (
  select series_id, 0 as k, []::double[] as phi, 1.0::double as v, 1.0::double as pacf from a
  union all
  select series_id, k + 1, list_append(list_transform(range(1, k + 1), lambda i: phi[i] - kap * phi[k + 1 - i]), kap),
    v * (1 - kap * kap), kap
  from (select rec.series_id, rec.k, rec.phi, rec.v, (a.r[rec.k + 2] - coalesce(list_sum(list_transform(
          range(1, rec.k + 1), lambda i: rec.phi[i] * a.r[rec.k + 2 - i])), 0)) / rec.v as kap
        from rec join a on a.series_id = rec.series_id where rec.k < 40) as step)
select rec.series_id, cast(k as integer) as lag, pacf,
  case when k = 0 then 0.0 else 1.959963984540054 / sqrt(n) end as band from rec join a on a.series_id = rec.series_id""",
       floats="pacf band")
def t03(spark, sf):
    return st.pacf(sku_daily(spark, sf), max_lag=LAGS)


@query("t05_diagnostics", SKU_DAILY + NAIVE + """, e as (select series_id, date, total_units - mixed as e,
  row_number() over (partition by series_id order by date) as i, count(*) over (partition by series_id) as n,
  (total_units - mixed) - avg(total_units - mixed) over (partition by series_id) as c from scored),
f as (select *, lag(c) over (partition by series_id order by date) as c1 from e),
g as (select series_id, max(n) as n, avg(e * e) as s2, sum(c * c1) / sum(c * c) as r1, avg(c ** 2) as m2, avg(c ** 3) as m3,
  avg(c ** 4) as m4, sum(e * e) filter (where i > n - cast(round(n / 3) as bigint))
    / sum(e * e) filter (where i <= cast(round(n / 3) as bigint)) as heteroskedasticity from f group by series_id),
h as (select *, -n / 2 * (ln(2 * pi() * s2) + 1) as loglik, m3 / m2 ** 1.5 as skew, m4 / (m2 * m2) as kurtosis,
  n * (n + 2) * r1 * r1 / (n - 1) as ljung_box from g),
j as (select *, n / 6 * (skew ** 2 + (kurtosis - 3) ** 2 / 4) as jarque_bera from h)
select series_id, n, loglik, 2 * 3 - 2 * loglik as aic, 3 * ln(n) - 2 * loglik as bic, 2 * 3 * ln(ln(n)) - 2 * loglik as hqic,
  ljung_box, t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    * exp(-ljung_box / 2) as ljung_box_p,
  jarque_bera, exp(-jarque_bera / 2) as jarque_bera_p, heteroskedasticity, skew, kurtosis
from (select *, 1 / (1 + 0.3275911 * sqrt(ljung_box / 2)) as t from j)""",
       floats="loglik aic bic hqic ljung_box ljung_box_p jarque_bera jarque_bera_p heteroskedasticity skew kurtosis", digits=4)
def t05(spark, sf):
    scored = naive_forecasts(sku_daily(spark, sf))
    errors = scored.select("series_id", "date", (F.col("total_units") - F.col("mixed")).alias("residuals"))
    return st.diagnostics(errors, 3)


def _regressions(name: str, lags: str) -> str:
    """The nested regressions of the unit-root test on the days from ``lags`` on: cross products of (1, level, lagged steps,
    step), swept one column at a time. Stage k of ``name`` has the first k columns; the last cell is what they leave."""
    return f"""{name}_rows as (select series_id, {lags} as lags, [1.0, v] || ds[2:1 + {lags}] || [ds[1]] as r from l where j >= {lags}),
{name}_start as (select series_id, lags, a, b, sum(r[a] * r[b]) as m, count(*) as n from {name}_rows, range(1, 40) i(a), range(1, 40) k(b)
  where a <= lags + 3 and b <= lags + 3 group by series_id, lags, a, b),
{name} as (select series_id, lags, n, 0 as k, a, b, m from {name}_start
  union all select series_id, lags, n, k + 1, a, b, case when a = k + 1 and b = k + 1 then 1 / middle when a = k + 1 then m / middle
    when b = k + 1 then -m / middle else m - above * beside / middle end
  from (select *, max(case when a = k + 1 and b = k + 1 then m end) over (partition by series_id) as middle,
    max(case when a = k + 1 then m end) over (partition by series_id, b) as above,
    max(case when b = k + 1 then m end) over (partition by series_id, a) as beside from {name} where k < lags + 2) as step)"""


def _unit_root(given: str, lag: str | None = None) -> str:
    """SQL of the test over the view ``given`` (series_id, date, x); the number of lags by AIC unless one is given."""
    chosen = f"select series_id, {lag} as lag from given group by series_id" if lag is not None else """select series_id,
  arg_min(k - 2, n * ln(m / n) + 2 * k) as lag from wide where k >= 2 and a = lags + 3 and b = lags + 3 group by series_id"""
    normal = """case when z < -8 then 0 when z > 8 then 1 else 0.5 + z * exp(-z * z / 2) / sqrt(2 * pi()) * list_sum(list_transform(
  range(0, 120), lambda k: exp(k * ln(z * z) - (k + 1) * ln(2) - lgamma(k + 1.5) + ln(pi()) / 2))) end"""
    return f"""{given}, c as (select series_id, date, x - avg(x) over (partition by series_id) as x,
  count(*) over (partition by series_id) as n from given),
s as (select series_id, n - 1 as size, row_number() over w - 2 as j, lag(x) over w as v, x - lag(x) over w as d from c
  window w as (partition by series_id order by date)),
l0 as (select *, list_reverse(list(d) over (partition by series_id order by j rows between 36 preceding and current row)) as ds,
  least(cast(ceil(12 * ((size + 1) / 100) ** 0.25) as integer), (size + 1) // 2 - 2) as most from s where j >= 0),
{_regressions("wide", "most").replace("from l where", "from l0 where") if lag is None else "unused as (select 1)"},
choice as ({chosen}),
l as (select * from l0 join choice using (series_id)),
{_regressions("narrow", "lag")},
fit as (select series_id, any_value(lags) as lags, any_value(n) as n, max(case when a = 2 and b = lags + 3 then m end) as beta,
  max(case when a = 2 and b = 2 then m end) as inv, max(case when a = lags + 3 and b = lags + 3 then m end) as sse
  from narrow where k = lags + 2 group by series_id),
stat as (select series_id, lags, n, beta / sqrt(sse / (n - 2 - lags) * inv) as stat from fit),
score as (select *, case when stat <= -1.61 then 2.1659 + 1.4412 * stat + 0.038269 * stat ** 2
  else 1.7339 + 0.93202 * stat - 0.12745 * stat ** 2 - 0.010368 * stat ** 3 end as z from stat),
tested as (select series_id, stat, case when stat > 2.74 then 1 when stat < -18.83 then 0 else {normal} end as pvalue,
  cast(lags as integer) as used_lag, cast(n as integer) as n_obs, -3.43035 - 6.5393 / n - 16.786 / n ** 2 - 79.433 / n ** 3 as crit_1,
  -2.86154 - 2.8903 / n - 4.234 / n ** 2 - 40.040 / n ** 3 as crit_5, -2.56677 - 1.5384 / n - 2.809 / n ** 2 as crit_10 from score),
adf as (select *, pvalue < 0.05 and stat < crit_5 as stationary from tested)"""


LEVELS = SKU_DAILY.replace("with demand", "with recursive demand", 1) + """,
given as (select series_id, date, cast(total_units as double) as x from daily)"""
ADF_FLOATS = "stat pvalue crit_1 crit_5 crit_10"


@query("t01_adf_test", _unit_root(LEVELS) + " select * from adf", floats=ADF_FLOATS, digits=5)
def t01(spark, sf):
    return st.adf_test(sku_daily(spark, sf))


@query("t01_adf_test_seven_lags", _unit_root(LEVELS, "7") + " select * from adf", floats=ADF_FLOATS, digits=5)
def t01_seven(spark, sf):
    return st.adf_test(sku_daily(spark, sf), max_lag=7, fixed=True)


# A random walk of each brand: the running sum of the units' deviations, where the test must not see a level.
WALKS = LEVELS.replace("given as (select", "plain as (select") + """,
given as (select series_id, date, sum(x - mean) over (partition by series_id order by date) as x
  from (select *, avg(x) over (partition by series_id) as mean from plain) as p)"""


@query("t01_adf_test_walks", _unit_root(WALKS) + " select * from adf", floats=ADF_FLOATS, digits=4)
def t01_walks(spark, sf):
    """Series with a unit root: running sums of deviations, so that p-values are not all 0."""
    running = Window.partitionBy("series_id").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    mean = F.avg(F.col("total_units").cast("double")).over(Window.partitionBy("series_id"))
    moved = sku_daily(spark, sf).select("series_id", "date", (F.col("total_units") - mean).alias("x"))
    return st.adf_test(moved.select("series_id", "date", F.sum("x").over(running).alias("walk")), "walk")


@query("t01_adf_test_no_lags", SKU_DAILY + """, d as (select series_id, lag(total_units) over w as x,
  total_units - lag(total_units) over w as y from daily window w as (partition by series_id order by date)),
r as (select series_id, count(x) as n, regr_slope(y, x) as b, regr_sxx(y, x) as sxx,
  regr_syy(y, x) - regr_sxy(y, x) ** 2 / regr_sxx(y, x) as sse from d where x is not null group by series_id)
select series_id, b / sqrt(sse / (n - 2) / sxx) as stat, 0 as used_lag, cast(n as integer) as n_obs,
  -2.86154 - 2.8903 / n - 4.234 / n ** 2 - 40.040 / n ** 3 as crit_5 from r""", floats="stat crit_5", digits=5)
def t01_no_lags(spark, sf):
    return st.adf_test(sku_daily(spark, sf), max_lag=0).select("series_id", "stat", "used_lag", "n_obs", "crit_5")


BOTH = LEVELS.replace("given as (select", "plain as (select") + """,
given as (select series_id || '/level' as series_id, date, x from plain union all
  select series_id || '/change', date, x from (select series_id, date,
    x - lag(x) over (partition by series_id order by date) as x from plain) as p where x is not null)"""


@query("t04_differencing_choice", _unit_root(BOTH) + """ select split_part(a.series_id, '/', 1) as series_id, a.stat as level_stat,
  b.stat as diff_stat, case when a.stationary then 'level' else 'first difference' end as use,
  case when a.stationary then 'd=0' when b.stationary then 'd=1' else 'higher or seasonal differencing' end as advice
  from adf a join adf b on a.series_id = split_part(b.series_id, '/', 1) || '/level' and b.series_id like '%/change'""",
       floats="level_stat diff_stat", digits=5)
def t04(spark, sf):
    return st.differencing_choice(sku_daily(spark, sf))
