"""Autocorrelation, unit-root test and residual diagnostics, for any number of series at once."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.shipping import ship_with_tasks
from tidemark.functions.toeplitz import levinson
from tidemark.operators.series import by_day, first_difference

ship_with_tasks(__name__)

Z95 = 1.959963984540054
TOGETHER = 512  # series whose regressions are solved side by side

# Critical values of the test with a constant, one variable
# (response surface b0 + b1/n + b2/n^2 + b3/n^3, MacKinnon 2010).
ADF_CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}
# Normal-quantile polynomials of the p-value, ascending powers (MacKinnon 1994).
ADF_P_SMALL = (2.1659, 1.4412, 0.038269)
ADF_P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_P_SPLIT, ADF_P_MIN, ADF_P_MAX = -1.61, -18.83, 2.74

ADF_SCHEMA = ("series_id string, stat double, pvalue double, used_lag int, n_obs int, "
              "crit_1 double, crit_5 double, crit_10 double, stationary boolean")


def autocorrelations(series: DataFrame, name: str, max_lag: int,
                     keys: tuple[str, ...] = ("series_id",)) -> DataFrame:
    """One row per series: ``n`` and ``acf``, the array r0..r(max_lag). Lags are shifted columns
    of one ordered pass and the products are summed in one aggregation. A constant series has
    NULL at every lag but 0, where it has 1."""
    by = ", ".join(keys)
    lags = range(1, max_lag + 1)
    centred = series.selectExpr(*keys, "date", f"{centre(name, by)} as _c")
    shifted = centred.selectExpr(*keys, "_c", *lag_columns("_c", lags, by))
    products = ["sum(_c * _c)"] + [f"coalesce(sum(_c * _c_{k}), 0D)" for k in lags]
    sums = shifted.groupBy(*keys).agg(F.expr("count(1) as n"), F.expr(f"array({', '.join(products)}) as _s"))
    return sums.selectExpr(
        *keys, "n", "transform(_s, (v, k) -> case when k = 0 then 1D when _s[0] > 0 then v / _s[0] end) as acf")


def centre(name: str, by: str) -> str:
    """Deviation from the series mean. Ordered like the lags, so that both share one sort."""
    x = f"cast({name} as double)"
    return f"{x} - avg({x}) over (partition by {by} order by date rows between unbounded preceding and unbounded following)"


def lag_columns(name: str, lags, by: str) -> list[str]:
    """Expressions ``name_k`` for each lag; as text, because a model needs many of them."""
    return [f"lag({name}, {k}) over (partition by {by} order by date) as {name}_{k}" for k in lags]


def acf(series: DataFrame, name: str = "total_units", max_lag: int = 40) -> DataFrame:
    """Autocorrelation per lag with the half width of its 95 % band (Bartlett)."""
    table = autocorrelations(series, name, max_lag)
    long = table.select("series_id", "n", "acf", F.posexplode("acf").alias("lag", "value"))
    earlier = F.aggregate(F.slice("acf", F.lit(2), F.greatest(F.col("lag") - 1, F.lit(0))),
                          F.lit(0.0), lambda s, r: s + r * r)
    band = F.when(F.col("lag") > 0, Z95 * F.sqrt((1 + 2 * earlier) / F.col("n"))).otherwise(0.0)
    return long.filter(F.col("lag") < F.col("n")).select("series_id", "lag", F.col("value").alias("acf"),
                                                         band.alias("band"))


def pacf(series: DataFrame, name: str = "total_units", max_lag: int = 40) -> DataFrame:
    """Partial autocorrelation per lag from the Yule-Walker equations (biased moments), for the lags
    that a series is long enough for."""
    table = autocorrelations(series, name, max_lag)
    values = F.concat(F.array(F.lit(1.0)), levinson(F.col("acf"), max_lag)["pacf"])
    long = table.select("series_id", "n", F.get("acf", F.lit(1)).isNull().alias("constant"), F.posexplode(values).alias("lag", "pacf"))
    return long.filter(F.col("lag") < F.col("n")).select(
        "series_id", "lag", F.when(~F.col("constant") | (F.col("lag") == 0), F.col("pacf")).alias("pacf"),
        F.when(F.col("lag") > 0, Z95 / F.sqrt("n")).otherwise(0.0).alias("band"))


def longest_lag(days: int) -> int:
    """Most lags of the unit-root test for a series of so many days."""
    return math.ceil(12 * (days / 100) ** 0.25)


def adf_sums(series: DataFrame, name: str, most: int) -> DataFrame:
    """What the unit-root test reads of a series, one row each: with ``d`` the steps between days and ``v`` the level
    before a step, the sums of ``d`` and ``v``, of ``d[t] d[t-k]`` and ``v[t] d[t-k]`` for k = 0..``most``, and the
    first and last ``most`` steps. Every cross product of a lagged regression follows from these (:func:`lag_matrix`).
    Lags are shifted columns of one ordered pass, sums one aggregation; the level is centred to keep digits."""
    by, lags = "series_id", range(1, most + 1)
    centred = series.filter(F.col(name).isNotNull()).selectExpr("series_id", "date", f"{centre(name, by)} as _c")
    steps = centred.selectExpr("series_id", "date", *lag_columns("_c", [1], by), "_c").selectExpr(
        "series_id", "date", "_c_1 as v", "_c - _c_1 as d",
        f"row_number() over (partition by {by} order by date) - 2 as j", f"count(1) over (partition by {by}) - 1 as steps")
    shifted = steps.selectExpr("series_id", "j", "steps", "v", "d", "d as d_0", *lag_columns("d", lags, by))
    products = {w: ", ".join(f"coalesce(sum({w} * d_{k}), 0D)" for k in range(most + 1)) for w in "dv"}
    edge = f"j >= 0 and (j < {most} or j >= steps - {most})"
    return shifted.groupBy("series_id").agg(
        F.expr("max(steps) as steps"), F.expr("coalesce(sum(d), 0D) as d"), F.expr("coalesce(sum(v), 0D) as v"),
        F.expr("coalesce(sum(v * v), 0D) as vv"), F.expr(f"array({products['d']}) as dd"), F.expr(f"array({products['v']}) as vd"),
        F.expr(f"collect_list(struct(j, v, d)) filter (where {edge}) as edges"))


def adf_test(series: DataFrame, name: str = "total_units", max_lag: int | None = None, fixed: bool = False) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, the number of lags chosen by AIC up to ``max_lag`` (by default a
    bound that grows with the length of the series), or ``max_lag`` itself if it is ``fixed``.

    The regressions run on sums (:func:`adf_sums`): a task sees some 100 numbers a series. A series that is constant,
    too short or perfectly explained by its lags has no statistic; days without a value are passed over. The longest series is one number for the driver."""
    if max_lag is None:
        days = series.groupBy("series_id").count().agg(F.max("count")).first()[0]
        most = longest_lag(days or 0)
    else:
        most = max_lag
    return adf_sums(series, name, most).mapInPandas(lambda batches: _adf_batches(batches, most, max_lag, fixed), ADF_SCHEMA)


def _adf_batches(batches, most: int, max_lag: int | None, fixed: bool):
    for batch in batches:
        for first in range(0, len(batch), TOGETHER):
            yield _adf(batch.iloc[first:first + TOGETHER], most, max_lag, fixed)


def _adf(rows: pd.DataFrame, most: int, max_lag: int | None, fixed: bool) -> pd.DataFrame:
    steps = rows["steps"].to_numpy()
    bound = np.array([longest_lag(n + 1) if max_lag is None else max_lag for n in steps])
    lags = np.minimum(bound, (steps + 1) // 2 - 2)
    sums = {c: np.array(rows[c].to_list(), float) for c in ("d", "v", "vv", "dd", "vd")}
    used = (lags >= 0) & (sums["dd"][:, 0] > 0)
    head_d, head_v, tail = np.zeros((3, len(rows), most))
    for i, edges in enumerate(rows["edges"]):
        for edge in edges if edges is not None else ():
            j = edge["j"]
            if j < most:
                head_d[i, j], head_v[i, j] = edge["d"], edge["v"]
            if j >= steps[i] - most:
                tail[i, j - steps[i]] = edge["d"]
    lags = np.where(used, lags, 0)
    if not fixed:
        left = eliminate(*lag_matrix(sums, head_d, head_v, tail, steps, lags, most), 2 + lags)[1]
        size = np.maximum(steps - lags, 1)[:, None]
        k = np.arange(most + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            aic = size * np.log(left[:, 2:] / size) + 2 * (2 + k)
        used &= np.isfinite(np.where(k <= lags[:, None], aic, 0.0)).all(axis=1)
        lags = np.argmin(np.where((k <= lags[:, None]) & used[:, None], aic, np.inf), axis=1)
    matrix, scale = lag_matrix(sums, head_d, head_v, tail, steps, lags, most)
    swept, left = eliminate(matrix, scale, 2 + lags)
    size = steps - lags
    variance = left[np.arange(len(rows)), 2 + lags] / np.maximum(size - 2 - lags, 1)
    spread = np.sqrt(variance * swept[:, 1, 1])  # coefficient and error share the unit of the level
    used &= spread > 0
    out = []
    for i, name in enumerate(rows["series_id"]):
        if not used[i]:
            out.append({"series_id": name})
            continue
        stat = float(swept[i, 1, -1] * scale[i, -1] / spread[i])
        crit = {c: sum(b / size[i] ** k for k, b in enumerate(bs)) for c, bs in ADF_CRITICAL.items()}
        p = _adf_p(stat)
        out.append({"series_id": name, "stat": stat, "pvalue": p, "used_lag": int(lags[i]), "n_obs": int(size[i]), **crit,
                    "stationary": p < 0.05 and stat < crit["crit_5"]})
    names = [c.split(" ")[0] for c in ADF_SCHEMA.split(", ")]
    return pd.DataFrame(out, columns=names).astype({"used_lag": "Int32", "n_obs": "Int32", "stationary": "boolean"})


def lag_matrix(sums: dict, head_d: np.ndarray, head_v: np.ndarray, tail: np.ndarray, steps: np.ndarray, first: np.ndarray,
               most: int) -> tuple[np.ndarray, np.ndarray]:
    """Cross products of (1, v, d lagged by 1..``most``, d) over the steps from ``first`` on, one matrix a series, scaled to a
    unit diagonal, and the scale. Products of whole series lose the steps before ``first``; moving both factors one step back
    adds the product in front of the sample and takes the last one. Lags beyond ``first`` are not meaningful."""
    n, cols = len(steps), most + 3
    at = np.arange(most)
    before = at < first[:, None]
    d, v = np.where(before, head_d, 0.0), np.where(before, head_v, 0.0)
    out = np.zeros((n, cols, cols))
    # Place of the step lagged by k: the target (lag 0) is the last column.
    place = np.array([cols - 1, *range(2, cols - 1)])
    lagged = np.zeros((n, most + 1, most + 1))
    ones, level = np.zeros((2, n, most + 1))
    for k in range(most + 1):
        lagged[:, 0, k] = sums["dd"][:, k] - (d[:, k:] * d[:, :most - k]).sum(axis=1)
        level[:, k] = sums["vd"][:, k] - (v[:, k:] * d[:, :most - k]).sum(axis=1)
    ones[:, 0] = sums["d"] - d.sum(axis=1)
    rows = np.arange(n)[:, None]
    reach = first[:, None] - 1 - at
    front = np.where(reach >= 0, head_d[rows, np.maximum(reach, 0)], 0.0) if most else np.zeros((n, 0))
    back = tail[:, ::-1]
    for a in range(most):
        ones[:, a + 1] = ones[:, a] + front[:, a] - back[:, a]
        lagged[:, a + 1, a + 1:] = lagged[:, a, a:-1] + front[:, a, None] * front[:, a:] - back[:, a, None] * back[:, a:]
    lagged = np.triu(lagged) + np.transpose(np.triu(lagged, 1), (0, 2, 1))
    out[:, place[:, None], place[None, :]] = lagged
    out[:, 0, 0] = np.maximum(steps - first, 1)
    out[:, 0, 1] = out[:, 1, 0] = sums["v"] - v.sum(axis=1)
    out[:, 1, 1] = sums["vv"] - (v * v).sum(axis=1)
    out[:, 0, place] = out[:, place, 0] = ones
    out[:, 1, place] = out[:, place, 1] = level
    scale = np.sqrt(np.maximum(np.diagonal(out, axis1=1, axis2=2), 0.0))
    scale = np.where(scale > 0, scale, 1.0)
    return out / (scale[:, :, None] * scale[:, None, :]), scale


def eliminate(matrix: np.ndarray, scale: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Regress the last column on the first ``columns`` ones, adding one column at a time to the normal equations. Returns
    the swept matrices (inverse, last column: coefficients) and, in units of the data, the sum of squares left after each
    column. A column that depends on earlier ones is passed over; what is left of a perfect fit is 0."""
    matrix = matrix.copy()
    most = matrix.shape[1] - 1
    left = np.zeros((len(matrix), most + 1))
    left[:, 0] = matrix[:, -1, -1]
    for k in range(most):
        pivot = matrix[:, k, k]
        used = (k < columns) & (pivot > 1e-11)
        pivot = np.where(used, pivot, 1.0)
        row, column = matrix[:, k, :] / pivot[:, None], matrix[:, :, k].copy()
        swept = matrix - column[:, :, None] * row[:, None, :]
        swept[:, k, :] = row
        swept[:, :, k] = -column / pivot[:, None]
        swept[:, k, k] = 1 / pivot
        matrix = np.where(used[:, None, None], swept, matrix)
        rest = matrix[:, -1, -1]
        left[:, k + 1] = np.where(rest > 1e-12, rest, 0.0)
    return matrix, left * scale[:, -1:] ** 2


def _adf_p(stat: float) -> float:
    if stat > ADF_P_MAX:
        return 1.0
    if stat < ADF_P_MIN:
        return 0.0
    powers = ADF_P_SMALL if stat <= ADF_P_SPLIT else ADF_P_LARGE
    return 0.5 * math.erfc(-sum(c * stat ** i for i, c in enumerate(powers)) / math.sqrt(2))


def differencing_choice(series: DataFrame, name: str = "total_units") -> DataFrame:
    """Level or first difference for further work, with the advised order of differencing."""
    change = first_difference(series, name).select("series_id", "date", F.col("diff").cast("double"))
    return choose_differencing(adf_test(series, name), adf_test(change, "diff"))


def choose_differencing(of_level: DataFrame, of_change: DataFrame) -> DataFrame:
    """The choice from the unit-root tests of the level and of its first difference."""
    level = of_level.select("series_id", F.col("stationary").alias("level_ok"), F.col("stat").alias("level_stat"))
    diff = of_change.select("series_id", F.col("stationary").alias("diff_ok"), F.col("stat").alias("diff_stat"))
    both = level.join(diff, "series_id", "left")
    return both.select(
        "series_id", "level_stat", "diff_stat",
        F.when(F.col("level_ok"), "level").otherwise("first difference").alias("use"),
        F.when(F.col("level_ok"), "d=0").when(F.col("diff_ok"), "d=1")
        .otherwise("higher or seasonal differencing").alias("advice"))


def _erfc(x: Column) -> Column:
    """Complementary error function for x >= 0 (Abramowitz and Stegun 7.1.26, error < 2e-7)."""
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def diagnostics(residuals: DataFrame, n_params: int | Column, name: str = "residuals") -> DataFrame:
    """Information criteria and residual tests per series. Rows before the effective sample must
    have been left out (see :func:`effective_sample`)."""
    whole = Window.partitionBy("series_id")
    e = F.col(name).cast("double")
    k = F.lit(n_params) if isinstance(n_params, int) else n_params
    rows = residuals.select(
        "series_id", e.alias("e"), k.alias("k"), F.row_number().over(by_day()).alias("i"),
        F.count(F.lit(1)).over(whole).alias("n"), (e - F.avg(e).over(whole)).alias("c"),
        (F.lag(e, 1).over(by_day()) - F.avg(e).over(whole)).alias("c1"))
    third = F.round(F.col("n") / 3).cast("bigint")
    c, square = F.col("c"), F.col("e") * F.col("e")
    sums = rows.groupBy("series_id").agg(
        F.max("n").alias("n"), F.max("k").alias("k"), F.avg(square).alias("s2"),
        (F.sum(c * F.col("c1")) / F.sum(c * c)).alias("r1"),
        F.avg(c * c).alias("m2"), F.avg(c * c * c).alias("m3"), F.avg(c * c * c * c).alias("m4"),
        (F.sum(F.when(F.col("i") > F.col("n") - third, square))
         / F.sum(F.when(F.col("i") <= third, square))).alias("heteroskedasticity"))
    n = F.col("n")
    stats = sums.withColumns({
        "loglik": -n / 2 * (F.log(2 * F.pi() * F.col("s2")) + 1),
        "skew": F.col("m3") / F.pow("m2", F.lit(1.5)),
        "kurtosis": F.col("m4") / (F.col("m2") * F.col("m2")),
        "ljung_box": n * (n + 2) * F.col("r1") * F.col("r1") / (n - 1)})
    excess = F.col("kurtosis") - 3
    stats = stats.withColumn("jarque_bera", n / 6 * (F.col("skew") * F.col("skew") + excess * excess / 4))
    return stats.select(
        "series_id", "n", "loglik", (2 * F.col("k") - 2 * F.col("loglik")).alias("aic"),
        (F.col("k") * F.log(n) - 2 * F.col("loglik")).alias("bic"),
        (2 * F.col("k") * F.log(F.log(n)) - 2 * F.col("loglik")).alias("hqic"),
        "ljung_box", _erfc(F.sqrt(F.col("ljung_box") / 2)).alias("ljung_box_p"),
        "jarque_bera", F.exp(-F.col("jarque_bera") / 2).alias("jarque_bera_p"),
        "heteroskedasticity", "skew", "kurtosis")


def effective_sample(residuals: DataFrame, coefficients: DataFrame, season: int = 7) -> DataFrame:
    """Drop the start-up days of each series: differences plus the longest lag of the model."""
    lost = (F.col("d") + season * F.col("sd") + F.greatest(
        F.col("p") + season * F.col("sp"), F.col("q") + season * F.col("sq") + 1))
    burn = coefficients.select("series_id", lost.alias("_lost"), F.size("beta").alias("_b"),
                               (F.col("p") + F.col("q") + F.col("sp") + F.col("sq") + 1).alias("_k"))
    joined = residuals.join(burn, "series_id").withColumn("_i", F.row_number().over(by_day()))
    return joined.filter(F.col("_i") > F.col("_lost")).withColumn(
        "n_params", F.col("_k") + F.col("_b")).drop("_lost", "_i", "_k", "_b")
