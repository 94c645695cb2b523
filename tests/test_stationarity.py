import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import stationarity as st
from tidemark.plans.explore import explore, explore_variants, stationarity_report


def frame(spark, **series):
    start = dt.date(2020, 1, 1)
    rows = [(name, start + dt.timedelta(days=i), float(v)) for name, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, date date, total_units double")


def brute_adf(x, most=None):
    """The test written out regression by regression."""
    x = np.asarray(x, float)
    d, most = np.diff(x), math.ceil(12 * (len(x) / 100) ** 0.25) if most is None else most

    def fit(lags, start):
        y = d[start:]
        cols = [np.ones(len(y)), x[start:-1]] + [d[start - k:len(d) - k] for k in range(1, lags + 1)]
        a = np.column_stack(cols)
        beta, *_ = np.linalg.lstsq(a, y, rcond=None)
        return a, y, beta, ((y - a @ beta) ** 2).sum()

    scores = []
    for lags in range(most + 1):
        a, y, _, sse = fit(lags, most)
        scores.append(len(y) * math.log(sse / len(y)) + 2 * a.shape[1])
    lag = int(np.argmin(scores))
    a, y, beta, sse = fit(lag, lag)
    se = math.sqrt(sse / (len(y) - a.shape[1]) * np.linalg.inv(a.T @ a)[1, 1])
    return beta[1] / se, lag, len(y)


def test_adf(spark):
    rng = np.random.default_rng(1)
    noise, walk = rng.normal(size=300), np.cumsum(rng.normal(size=300))
    ar = [0.0]
    for e in rng.normal(size=300):
        ar.append(0.8 * ar[-1] + e)
    df = frame(spark, noise=noise, walk=walk, ar=ar, flat=np.ones(100), short=[1, 2])
    got = {r["series_id"]: r for r in st.adf_test(df).collect()}
    for name, x in (("noise", noise), ("walk", walk), ("ar", ar)):
        stat, lag, n = brute_adf(x)
        assert got[name]["stat"] == pytest.approx(stat, rel=1e-8)
        assert (got[name]["used_lag"], got[name]["n_obs"]) == (lag, n)
    assert got["noise"]["stationary"] and not got["walk"]["stationary"]
    assert got["flat"]["stat"] is None and got["short"]["stat"] is None
    assert got["noise"]["crit_5"] == pytest.approx(-2.87, abs=0.01)


def test_adf_of_many_short_and_odd_series(spark):
    """Against the regressions written out, where the first and last days overlap, and without a crash elsewhere."""
    rng = np.random.default_rng(11)
    many = {f"s{n}": np.cumsum(rng.normal(size=n)) + 100 for n in (12, 19, 33, 60, 141)}
    odd = {"one": [5], "two": [5, 6], "trend": np.arange(50), "flips": [1, 2] * 30, "gap": [0] * 30 + [4] + [0] * 30}
    got = {r["series_id"]: r for r in st.adf_test(frame(spark, **many, **odd), max_lag=3).collect()}
    assert set(got) == set(many) | set(odd)
    for name, x in many.items():
        stat, lag, n = brute_adf(x, 3)
        assert got[name]["stat"] == pytest.approx(stat, rel=1e-6)
        assert (got[name]["used_lag"], got[name]["n_obs"]) == (lag, n)
    assert all(got[k]["stat"] is None for k in ("one", "two", "trend", "flips"))
    fixed = st.adf_test(frame(spark, **many), max_lag=2, fixed=True).collect()
    assert {r["used_lag"] for r in fixed} == {2}
    assert st.adf_test(frame(spark, **many).limit(0)).count() == 0


def test_adf_p_values_agree_with_the_critical_values():
    for stat, p in ((-3.43035, 0.01), (-2.86154, 0.05), (-2.56677, 0.10)):
        assert st._adf_p(stat) == pytest.approx(p, abs=0.002)
    assert st._adf_p(3.0) == 1.0 and st._adf_p(-20.0) == 0.0
    assert abs(st._adf_p(-1.6099) - st._adf_p(-1.6101)) < 1e-2


def test_differencing_choice(spark):
    rng = np.random.default_rng(2)
    df = frame(spark, noise=rng.normal(size=250), walk=np.cumsum(rng.normal(size=250)))
    got = {r["series_id"]: (r["use"], r["advice"]) for r in st.differencing_choice(df).collect()}
    assert got == {"noise": ("level", "d=0"), "walk": ("first difference", "d=1")}


def test_correlations(spark):
    rng = np.random.default_rng(3)
    x = np.convolve(rng.normal(size=220), [1, 0.6, 0.3], "valid")
    c = x - x.mean()
    r = np.array([1.0] + [(c[k:] * c[:-k]).sum() / (c * c).sum() for k in range(1, 13)])
    acf = [row["acf"] for row in st.acf(frame(spark, a=x), max_lag=12).orderBy("lag").collect()]
    assert acf == pytest.approx(list(r))
    pacf = st.pacf(frame(spark, a=x), max_lag=12).orderBy("lag").collect()
    want = [1.0] + [np.linalg.solve(r[np.abs(np.subtract.outer(range(k), range(k)))], r[1:k + 1])[-1] for k in range(1, 13)]
    assert [row["pacf"] for row in pacf] == pytest.approx(want)
    assert pacf[3]["band"] == pytest.approx(1.96 / math.sqrt(len(x)), abs=1e-4)


def test_short_series_has_no_lags_beyond_its_end(spark):
    assert st.acf(frame(spark, a=[1, 2, 4, 3]), max_lag=10).agg(F.max("lag")).first()[0] == 3
    assert st.pacf(frame(spark, a=[1, 2, 4, 3]), max_lag=10).agg(F.max("lag")).first()[0] == 3


def test_constant_series_have_undefined_correlations(spark):
    for table in (st.acf(frame(spark, a=[2] * 20), max_lag=3), st.pacf(frame(spark, a=[2] * 20), max_lag=3)):
        values = {r["lag"]: r[2] for r in table.collect()}
        assert values[0] == 1.0 and [values[k] for k in (1, 2, 3)] == [None] * 3


def test_diagnostics_of_noise(spark):
    rng = np.random.default_rng(4)
    e = rng.normal(size=400)
    df = frame(spark, a=e).withColumnRenamed("total_units", "residuals")
    row = st.diagnostics(df, 2).first()
    c = e - e.mean()
    skew, kurt = (c ** 3).mean() / (c ** 2).mean() ** 1.5, (c ** 4).mean() / (c ** 2).mean() ** 2
    assert row["skew"] == pytest.approx(skew) and row["kurtosis"] == pytest.approx(kurt)
    assert row["jarque_bera"] == pytest.approx(400 / 6 * (skew ** 2 + (kurt - 3) ** 2 / 4))
    q = 400 * 402 * ((c[1:] * c[:-1]).sum() / (c * c).sum()) ** 2 / 399
    assert row["ljung_box"] == pytest.approx(q)
    assert row["ljung_box_p"] == pytest.approx(math.erfc(math.sqrt(q / 2)), abs=1e-6)
    assert row["heteroskedasticity"] == pytest.approx((e[-133:] ** 2).sum() / (e[:133] ** 2).sum())
    loglik = -200 * (math.log(2 * math.pi * (e ** 2).mean()) + 1)
    assert row["bic"] == pytest.approx(2 * math.log(400) - 2 * loglik)


def test_reports(spark):
    rng = np.random.default_rng(5)
    start = dt.date(2020, 1, 1)
    rows = spark.createDataFrame(
        [(start + dt.timedelta(days=i), s, int(v), 2.0, i % 2) for s in "AB" for i, v in enumerate(rng.integers(0, 50, 120))],
        "date date, sku_id string, units_sold long, price double, promotion_flag int")
    tables = stationarity_report(rows, max_lag=8)
    assert tables["acf"].count() == 9 and tables["choice"].first()["use"] == "level"
    assert stationarity_report(rows, "sku_id", 5)["pacf"].count() == 12
    names = explore(rows)
    assert names["per_sku_summary"].count() == 2 and names["price_sample"].count() == 240
    both = explore_variants({"x": rows, "y": rows}, "2020-02-01")
    assert both["summary"].count() == 4 and both["train"].count() == 2 * 2 * 31
