import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar_features
from tidemark.operators import linear as ln, nonlinear as nl
from tidemark.operators.features import feature_columns
from tidemark.plans.forecast import run_forecast
from tidemark.plans.train import (MODELS, Settings, backtest_one_step, forecast_with_regressors, train, train_hybrid,
                                  train_with_regressors)
from tidemark.operators.trees import Forest, follow_blocks, forests, nodes_of
from tidemark.sources.registry import commit_version, current_version, latest_metrics, new_version
from tidemark.sources.sales import read_sales

START = dt.date(2021, 1, 1)


def frame(spark, **series):
    rows = [(name, START + dt.timedelta(days=i), float(v)) for name, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, date date, total_units double")


def arma(n, ar, ma, seed, burn=200):
    e = np.random.default_rng(seed).normal(size=n + burn)
    w = np.zeros(n + burn)
    for t in range(20, n + burn):
        w[t] = sum(c * w[t - k] for k, c in ar.items()) + e[t] + sum(c * e[t - k] for k, c in ma.items())
    return w[burn:]


def seasonal(n, seed):
    rng, t = np.random.default_rng(seed), np.arange(n)
    return 600 + 0.2 * t + np.array([0, 40, 80, 20, -60, 200, 150])[t % 7] + rng.normal(0, 110, n)


def test_coefficients_are_recovered(spark):
    values = {f"s{i}": arma(1100, {1: 0.5}, {1: 0.4, 7: -0.5, 8: -0.2}, seed=i) for i in range(4)}
    found = ln.candidate_models(frame(spark, **values)).filter("d = 0 and sd = 0 and p = 1 and q = 1 and sp = 0 and sq = 1")
    rows = found.collect()
    assert len(rows) == 4
    assert np.mean([r["ar"][0] for r in rows]) == pytest.approx(0.5, abs=0.1)
    assert np.mean([r["ma"][0] for r in rows]) == pytest.approx(0.4, abs=0.1)
    assert np.mean([r["ma"][6] for r in rows]) == pytest.approx(-0.5, abs=0.1)


def test_every_candidate_passes_the_root_guard(spark):
    found = ln.candidate_models(frame(spark, a=seasonal(400, 0))).collect()
    assert 1 < len(found) <= 144
    for r in found:
        for coefficients, limit in ((r["ar"], 1.0), ([-c for c in r["ma"]], 0.98)):
            roots = np.roots([1.0, *[-c for c in coefficients]])
            assert np.abs(roots).max(initial=0.0) < limit + 1e-6
    ranks = [r["rank"] for r in found]
    assert len(set(ranks)) == len(ranks)


def test_search_takes_the_least_aic_and_the_earlier_on_ties(spark):
    df = frame(spark, a=seasonal(300, 1), b=arma(300, {1: 0.7}, {}, 5))
    found = {}
    for r in ln.candidate_models(df).collect():
        found.setdefault(r["series_id"], []).append((r["aic"], r["rank"]))
    for r in ln.search_orders(df).collect():
        assert (r["aic"], r["rank"]) == min(found[r["series_id"]])
        assert r["admissible"] == len(found[r["series_id"]])


def test_plain_search_has_no_season(spark):
    row = ln.search_orders(frame(spark, a=arma(500, {1: 0.6}, {}, 3)), grid=ln.Grid.plain()).first()
    assert row["sd"] == row["sp"] == row["sq"] == 0 and len(row["ar"]) == 3
    assert len(ln.Grid.plain().orders) * 2 == 32 and len(ln.Grid().orders) * 4 == 144


def test_recursion_equals_the_definition(spark):
    rng = np.random.default_rng(7)
    x, h = np.cumsum(rng.normal(size=60)) + 50, 10
    z = rng.normal(size=(70, 1))
    days = [(START + dt.timedelta(days=i)) for i in range(70)]
    rows = [("a", d, float(v), float(r)) for d, v, r in zip(days, np.append(x, np.zeros(h)), z[:, 0])]
    daily = spark.createDataFrame(rows, "series_id string, date date, total_units double, r double")
    model = spark.createDataFrame([("a", 1, 1, 0.0, [0.3, 0.0, 0.0, 0.0, 0.0, 0.0, 0.2, 0.0, 0.0],
                                    [-0.4, 0.0, 0.0, 0.0, 0.0, 0.0, -0.3, 0.0, 0.0], [2.0])],
                                  "series_id string, d int, sd int, intercept double, ar array<double>, ma array<double>, beta array<double>")
    cut = F.lit(days[60])
    run = ln.run_model(daily.filter(F.col("date") < cut), model, daily.filter(F.col("date") >= cut), exog=("r",))
    got = [r["fitted"] for r in run.orderBy("date").collect()]
    full, w, e, want = list(x), {}, {}, {}
    zw = lambda t: z[t, 0] - z[t - 1, 0] - z[t - 7, 0] + z[t - 8, 0]
    for t in range(8, 70):
        guess = 0.3 * w.get(t - 1, 0) + 0.2 * w.get(t - 7, 0) - 0.4 * e.get(t - 1, 0) - 0.3 * e.get(t - 7, 0) + 2.0 * zw(t)
        base = full[t - 1] + full[t - 7] - full[t - 8]
        want[t] = base + guess
        if t >= 60:
            full.append(want[t])
        w[t], e[t] = full[t] - base, full[t] - base - guess
    assert got[:8] == [None] * 8
    assert got[8:] == pytest.approx([want[t] for t in range(8, 70)])


def test_beats_last_week_on_seasonal_series(spark):
    values = {f"s{i}": seasonal(790, 10 + i) for i in range(4)}
    df = frame(spark, **values)
    cut = START + dt.timedelta(days=700)
    past, test = df.filter(F.col("date") < F.lit(cut)), df.filter(F.col("date") >= F.lit(cut))
    forecast = ln.forecast_linear(past, ln.search_orders(past), test)
    both = forecast.join(test, ["series_id", "date"]).toPandas()
    assert len(both) == 4 * 90
    model = np.sqrt(((both["predicted_units"] - both["total_units"]) ** 2).mean())
    naive = np.sqrt(np.mean([(x[700:] - np.tile(x[693:700], 13)[:90]) ** 2 for x in values.values()]))
    assert model < naive


def test_fitted_values_start_after_the_differences(spark):
    df = frame(spark, a=seasonal(200, 2))
    coefficients = ln.search_orders(df).withColumns({"d": F.lit(1), "sd": F.lit(1)})
    fitted = ln.apply_linear(df, coefficients).orderBy("date").collect()
    assert [r["fitted"] is None for r in fitted] == [True] * 8 + [False] * 192


def test_regressor_effect_is_found(spark):
    rng = np.random.default_rng(11)
    promo = (rng.random(500) < 0.3).astype(int)
    df = calendar_features(frame(spark, a=100 + 50 * promo + rng.normal(0, 3, 500)))
    flags = spark.createDataFrame([(START + dt.timedelta(days=i), int(p), 5.0) for i, p in enumerate(promo)],
                                  "date date, promo_any int, avg_price double")
    df = df.join(flags, "date")
    cut = F.lit(START + dt.timedelta(days=450))
    coefficients, forecast = train_with_regressors(df.filter(F.col("date") < cut), df.filter(F.col("date") >= cut))
    spread = np.std(promo[:450])
    assert coefficients.first()["beta"][1] / spread == pytest.approx(50, abs=4)
    errors = forecast.join(df, ["series_id", "date"]).select(F.abs(F.col("predicted_units") - F.col("total_units"))).toPandas()
    assert len(errors) == 50 and errors.iloc[:, 0].mean() < 8


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """Two products over 200 days as CSV: train, test and a folder of trained models."""
    root = tmp_path_factory.mktemp("shop")
    units = np.maximum(seasonal(200, 4), 0)
    rows = [((START + dt.timedelta(days=i)).isoformat(), sku, int(u * share), 5.0 + i % 3, int(i % 5 == 0))
            for i, u in enumerate(units) for sku, share in (("A", 0.75), ("B", 0.25))]
    table = pd.DataFrame(rows, columns=["Date", "SKU", "Qty", "Price", "Promo"])
    edge = (START + dt.timedelta(days=170)).isoformat()
    table[table["Date"] < edge].to_csv(root / "train.csv", index=False)
    table[table["Date"] >= edge].to_csv(root / "test.csv", index=False)
    table.to_csv(root / "all.csv", index=False)
    metrics = train(spark, str(root / "train.csv"), str(root / "test.csv"), str(root / "models"), "run-1",
                    "2024-01-01 00:00:00", Settings(rounds=2, depth=2)).collect()
    return root, metrics


def test_training_reports_three_models(spark, shop):
    root, metrics = shop
    assert sorted(r["model"] for r in metrics) == sorted(MODELS)
    assert all(r["rmse"] > 0 and np.isfinite(r["mape"]) for r in metrics)
    latest = latest_metrics(spark, str(root / "models" / "runs")).first()
    assert latest["train_size"] == 170 and latest["test_size"] == 30 and len(latest["metrics"]) == 6
    forecasts = spark.read.parquet(f"{current_version(spark, str(root / 'models'))}/series/forecasts")
    assert forecasts.count() == 30 and forecasts.filter("hybrid is null").count() == 0


def test_one_step_backtest(spark, shop):
    root, _ = shop
    rows = backtest_one_step(read_sales(spark, str(root / "all.csv")), str(root / "models"))
    assert rows.count() == 200 - 30
    assert rows.filter("predicted_units < 0").count() == 0


def test_future_forecast(spark, shop):
    root, _ = shop
    args = (spark, str(root / "all.csv"), 1, "2021-08-10", str(root / "models"))
    result = run_forecast(*args)
    daily = result.sku_daily.toPandas()
    # Day before the 28th: the forecast starts on 1 September and loses the 22 days before it.
    assert sorted(set(daily["sku_id"])) == ["A", "B"] and len(daily) == 2 * (91 - 22)
    assert str(daily["date"].min()) == "2021-09-01"
    total = result.total_daily.toPandas()
    parts = daily.groupby("date")["predicted_units"].sum().sort_index()
    assert np.abs(parts.to_numpy() - total.sort_values("date")["predicted_units"].to_numpy()).max() <= 1
    quarters = result.sku_quarterly.orderBy("sku_id", "start_date").collect()
    assert [(r["sku_id"], r["quarter_label"]) for r in quarters] == [
        ("A", "Q3 2021"), ("A", "Q4 2021"), ("B", "Q3 2021"), ("B", "Q4 2021")]
    assert result.summary.first()["horizon"] == "1 quarters (69 days)" and result.summary.first()["skus"] == 2
    assert result.sku_points.count() == len(daily)
    shifted = run_forecast(*args, clean=True, legacy_shift=True).total_daily.agg(F.min("date"), F.count("date")).first()
    assert (str(shifted[0]), shifted[1]) == ("2021-09-01", 69)


def test_blocks_of_one_and_seven_agree_on_the_first_day(spark, shop):
    root, _ = shop
    stored = current_version(spark, str(root / "models"))
    model = nl.NonlinearModel.load(spark, f"{stored}/nonlinear", "residuals")
    train_days = spark.read.parquet(f"{stored}/series/train").withColumn("residuals", F.lit(1.0))
    assert model.columns == feature_columns("residuals")
    seven = nl.forecast_future(model, train_days, 9).orderBy("date").collect()
    single = nl.forecast_future(model, train_days, 3, block=1).orderBy("date").collect()
    assert [str(r["date"]) for r in seven] == [str(START + dt.timedelta(days=170 + i)) for i in range(9)]
    assert seven[0]["predicted_units"] == pytest.approx(single[0]["predicted_units"])


def test_a_training_that_dies_leaves_the_last_models(spark, shop, monkeypatch):
    root, _ = shop
    folder, files = str(root / "models"), [str(root / f"{part}.csv") for part in ("train", "test")]
    before, version = backtest_one_step(read_sales(spark, files[0]), folder).collect(), current_version(spark, folder)

    def dies(*args, **kwargs):
        raise RuntimeError("executors lost")

    monkeypatch.setattr("tidemark.plans.train.fit_nonlinear", dies)
    with pytest.raises(RuntimeError):
        train(spark, *files, folder, "run-2", "2024-01-02 00:00:00", Settings(rounds=2, depth=2, grid=ln.Grid.plain()))
    assert current_version(spark, folder) == version
    assert sorted(backtest_one_step(read_sales(spark, files[0]), folder).collect()) == sorted(before)
    assert latest_metrics(spark, f"{folder}/runs").first()["run_id"] == "run-1"


def test_the_version_committed_last_is_read(spark, tmp_path):
    folder = str(tmp_path / "store")
    assert current_version(spark, folder) == folder
    versions = [new_version(folder) for _ in range(3)]
    for version in versions[:2]:
        commit_version(spark, version)
        assert current_version(spark, folder) == version


def test_flat_trees_predict_what_the_fitted_trees_do(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 5))
    y = np.where(x[:, 1] > 0, x[:, 0], -x[:, 3]) + 0.1 * x[:, 4]
    data = spark.createDataFrame([(Vectors.dense(row.tolist()), float(v)) for row, v in zip(x, y)], ["features", "y"])
    fitted = GBTRegressor(labelCol="y", maxIter=6, maxDepth=4, seed=1).fit(data)
    want = [r["prediction"] for r in fitted.transform(data).collect()]
    nodes = nodes_of(fitted.toDebugString, 0)
    assert nodes["tree"].nunique() == 6 and (nodes["feature"] < 0).sum() == sum(t.numNodes // 2 + 1 for t in fitted.trees)
    assert Forest(nodes)(x) == pytest.approx(want, abs=1e-12)


def test_blocks_side_by_side_equal_one_series_after_the_other(spark):
    """Two output steps, the second one of yesterday's regressor, written out day by day."""
    first = nodes_of("Tree 0 (weight 1.0):\n If (feature 2 <= 0.5)\n Predict: 0.9\n Else (feature 2 > 0.5)\n Predict: 0.1", 0)
    second = nodes_of("Tree 0 (weight 2.0):\n If (feature 3 <= 0.0)\n Predict: -1.0E-1\n Else (feature 3 > 0.0)\n Predict: 0.3", 1)
    steps = forests(pd.concat([first, second]))
    rng = np.random.default_rng(7)
    seeds, ahead = rng.random((3, 2, 2)), rng.normal(size=(3, 7, 1))
    got = follow_blocks(seeds, ahead, steps, 2)
    for s in range(3):
        days = [tuple(d) for d in seeds[s]]
        for b in range(0, 7, 2):
            y, z = days[-1]
            guess = [0.9 if y <= 0.5 else 0.1, 2 * (-0.1 if z <= 0 else 0.3)]
            days += [(guess[k], ahead[s, b + k, 0]) for k in range(min(2, 7 - b))]
        assert got[s] == pytest.approx([d[0] for d in days[2:]])


@pytest.fixture(scope="module")
def odd_catalog(spark):
    """A constant, a 10-day, a 60-day and a normal product."""
    t = np.arange(400)
    values = {"constant": np.full(400, 7.0), "ten": 3.0 + t[:10] % 2, "sixty": seasonal(60, 3), "normal": seasonal(400, 4)}
    flags = F.col("date").isNotNull().cast("int")
    return calendar_features(frame(spark, **values).withColumns({"avg_price": F.lit(5.0), "promo_any": flags})), values


def test_every_series_gets_a_model_and_a_forecast(spark, odd_catalog, tmp_path):
    daily, values = odd_catalog
    found = {r["series_id"]: r for r in ln.search_orders(daily).collect()}
    assert set(found) == set(values)
    assert {s for s, r in found.items() if r["fallback"]} >= {"constant", "ten"} and not found["normal"]["fallback"]
    assert found["ten"]["intercept"] == pytest.approx(np.mean(values["ten"])) and found["ten"]["admissible"] == 0
    ends = daily.groupBy("series_id").agg(F.max("date").alias("hi"))
    future = calendar_features(ends.select("series_id", F.explode(F.sequence(F.date_add("hi", 1), F.date_add("hi", 10))).alias("date"))
                               .withColumns({"avg_price": F.lit(5.0), "promo_any": F.lit(1), "total_units": F.lit(1.0)}))
    folder = str(tmp_path / "models")
    forecasts = train_hybrid(daily, future, folder, Settings(rounds=2, depth=2)).collect()
    assert {(r["series_id"]) for r in forecasts} == set(values) and len(forecasts) == 40
    assert all(r[m] is not None and np.isfinite(r[m]) for r in forecasts for m in MODELS)
    assert all(r["linear_only"] == pytest.approx(7.0) for r in forecasts if r["series_id"] == "constant")
    assert all(r["hybrid"] == pytest.approx(r["linear_only"]) for r in forecasts if r["series_id"] == "ten")
    assert {r["series_id"] for r in spark.read.parquet(f"{folder}/short_series").collect()} == {"ten", "sixty"}
    fitted = ln.apply_linear(daily, spark.read.parquet(f"{folder}/linear"))
    assert fitted.count() == sum(map(len, values.values()))
    model = nl.NonlinearModel.load(spark, f"{folder}/nonlinear", "residuals")
    ahead = nl.forecast_future(model, daily.withColumn("residuals", F.lit(0.5)), 9)
    assert {r["series_id"]: r["count"] for r in ahead.groupBy("series_id").count().collect()} == dict.fromkeys(values, 9)


def test_a_series_without_stored_model_follows_its_mean(spark, odd_catalog):
    daily, values = odd_catalog
    known = ln.search_orders(daily).filter("series_id = 'normal'")
    fitted = ln.apply_linear(daily, known).filter("series_id = 'ten'").select("fitted").distinct().collect()
    assert [r["fitted"] for r in fitted] == [pytest.approx(np.mean(values["ten"]))]


def test_coefficient_table_against_least_squares(spark):
    x = arma(600, {1: 0.6}, {}, 8) + 5
    daily = frame(spark, a=x)
    model = ln.candidate_models(daily).filter("d = 0 and sd = 0 and p = 2 and q = 0 and sp = 0 and sq = 0").withColumn("fallback", F.lit(False))
    table = {r["term"]: r for r in ln.coefficient_table(daily, model).collect()}
    lost = ln.Grid().start_up
    design = np.column_stack((np.ones(600 - lost), x[lost - 1:-1], x[lost - 2:-2]))
    beta, *_ = np.linalg.lstsq(design, x[lost:], rcond=None)
    variance = ((x[lost:] - design @ beta) ** 2).mean()
    errors = np.sqrt(np.diag(variance * np.linalg.inv(design.T @ design)))
    for term, b, e in zip(("intercept", "ar.L1", "ar.L2"), beta, errors):
        r = table[term]
        assert (r["estimate"], r["std_error"], r["z"]) == (pytest.approx(b), pytest.approx(e), pytest.approx(b / e))
        assert (r["low"], r["high"]) == (pytest.approx(b - 1.96 * e, rel=1e-3), pytest.approx(b + 1.96 * e, rel=1e-3))
    assert table["sigma2"]["estimate"] == pytest.approx(variance)


def test_stored_regressor_model_is_applied(spark, odd_catalog, tmp_path):
    daily, _ = odd_catalog
    normal = daily.filter("series_id = 'normal'")
    cut = F.lit(START + dt.timedelta(days=380))
    past, test = normal.filter(F.col("date") < cut), normal.filter(F.col("date") >= cut)
    _, forecast = train_with_regressors(past, test, folder=str(tmp_path))
    again = forecast_with_regressors(past, test, str(tmp_path))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, forecast.collect()))


def lag_by_lag(x, grid, d, sd):
    """Cross products of one order of differencing by plain loops."""
    w = {t: x[t] - (x[t - 1] if d else 0) - (x[t - 7] if sd else 0) + (x[t - 8] if d and sd else 0)
         for t in range(d + 7 * sd, len(x))}
    mean = sum(w.values()) / len(w)
    c = [v - mean for v in w.values()]
    r = [sum(a * b for a, b in zip(c[k:], c)) for k in range(grid.long_order + 1)]
    toeplitz = np.array([[r[abs(i - j)] for j in range(grid.long_order)] for i in range(grid.long_order)])
    phi = np.linalg.solve(toeplitz, r[1:])
    first = min(w)
    e = {t: c[t - first] - sum(phi[k - 1] * c[t - first - k] for k in range(1, grid.long_order + 1))
         for t in list(w)[grid.long_order:]}
    rows = [[w[t], 1, *[w[t - k] for k in grid.all_lags], *[e[t - k] for k in grid.all_lags]]
            for t in w if t >= grid.start_up]
    return np.array(rows).T @ np.array(rows)


@pytest.mark.parametrize("d, sd", [(0, 0), (0, 1), (1, 0), (1, 1)])
def test_cross_products_are_those_of_plain_loops(d, sd):
    rng = np.random.default_rng(d + 2 * sd)
    x = 20 + 5 * np.sin(np.arange(200) * 2 * np.pi / 7) + rng.normal(size=200)
    grid = ln.Grid()
    got = {(a, b): full for a, b, _, full in ln.series_products(x, np.zeros((200, 0)), grid)}
    assert got[d, sd] == pytest.approx(lag_by_lag(list(x), grid, d, sd), rel=1e-8, abs=1e-6)


def test_short_and_constant_series_have_no_products():
    assert list(ln.series_products(np.full(200, 3.0), np.zeros((200, 0)), ln.Grid())) == []
    assert list(ln.series_products(np.arange(30.0), np.zeros((30, 0)), ln.Grid())) == []


def test_root_test_is_that_of_the_companion_matrix():
    rng = np.random.default_rng(3)
    c = rng.normal(scale=0.35, size=(3_000, 9)) * (rng.random((3_000, 9)) < 0.6)
    companion = np.zeros((3_000, 9, 9))
    companion[:, 0, :] = c
    companion[:, np.arange(1, 9), np.arange(8)] = 1
    largest = np.abs(np.linalg.eigvals(companion)).max(axis=1)
    for limit in (0.98, 1.0):
        clear = np.abs(largest - limit) > 1e-6
        assert (ln.roots_within(c, limit) == (largest < limit))[clear].all() and 0.1 < (largest < limit).mean() < 0.9


def test_series_side_by_side_are_followed_as_one_by_one():
    """Different lengths, gaps, differencing, missing models and regressors in one step."""
    rng = np.random.default_rng(4)
    models = [{"d": 1, "sd": 1, "intercept": 0.5, "ar": [0.3, 0.1], "ma": [-0.4], "beta": [2.0]}, {"intercept": 4.0},
              {"d": 0, "sd": 1, "intercept": 0.0, "ar": [0.2] * 9, "ma": [0.1] * 9, "beta": [None]}, {"intercept": None}]
    series = [rng.normal(10, 2, n) for n in (60, 12, 40, 5)]
    series[0][[20, 21, 55]], series[3][:] = np.nan, np.nan
    regressors = [rng.normal(size=(len(x), 1)) for x in series]
    together = ln.follow(series, regressors, models, 7)
    for x, z, m, got in zip(series, regressors, models, together):
        known, w, e = [], [], []
        beta = (m.get("beta") or [0.0])[0] or 0.0
        level = [beta * v for v in z[:, 0]]
        for t, value in enumerate(x):
            def taken(values):
                parts = ([values[t - 1]] if m.get("d") and t >= 1 else [None] if m.get("d") else []) + \
                    ([values[t - 7]] if m.get("sd") and t >= 7 else [None] if m.get("sd") else []) + \
                    ([-values[t - 8]] if m.get("d") and m.get("sd") and t >= 8 else [None] if m.get("d") and m.get("sd") else [])
                return None if any(p is None or p != p for p in parts) else sum(parts)
            base, off = taken(known), taken(level)
            guess = (np.nan if m["intercept"] is None else m["intercept"]) + level[t] - (off or 0.0)
            guess += sum(a * v for a, v in zip(m.get("ar") or [], w[::-1])) + sum(a * v for a, v in zip(m.get("ma") or [], e[::-1]))
            fitted = np.nan if base is None else base + guess
            assert got[t] == pytest.approx(fitted, nan_ok=True)
            now = fitted if value != value else value
            known.append(now)
            w.append(0.0 if base is None or now != now else now - base)
            e.append(0.0 if now != now or fitted != fitted else now - fitted)


def test_a_sparse_series_travels_as_its_sales(spark):
    """A packed series holds runs, not days, and comes back row by row, whatever the order of its rows."""
    days = [(name, START + dt.timedelta(days=i), 5.0 + i if i % 100 == 0 else 0.0, None if i % 300 == 7 else 1.0)
            for name in ("a", "b", None) for i in range(1000)]
    noisy = [("c", START + dt.timedelta(days=i), float(i % 7), float(i)) for i in range(3000)]
    schema = "series_id string, date date, x double, z0 double"
    for rows in (days, days[::-1], days + noisy):
        light = ln.packed(spark.createDataFrame(rows, schema).coalesce(1)).collect()
        if rows is days:
            assert len(light) <= 6 and sum(len(r["x"]) for r in light) <= 3 * 25 and all(len(r["date"]) == 1 for r in light)
        frame_ = ln.by_series(ln.packed(spark.createDataFrame(rows, schema)).withColumn("kind", F.lit(1)))

        def back(batches):
            for name, found in ln.unpacked_series(batches, "kind", "date"):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), *[found.column(c).combine_chunks() for c in ("date", "x", "z0")]],
                    names=["series_id", "date", "x", "z0"])

        got = [tuple(r) for r in frame_.mapInArrow(back, schema).collect()]
        assert sorted(got, key=repr) == sorted(rows, key=repr)
        for name in ("a", "b", None, "c"):
            assert [r[1] for r in got if r[0] == name] == sorted(r[1] for r in rows if r[0] == name)


def test_days_are_packed_before_they_travel(spark):
    rows = [(f"s{k}", START + dt.timedelta(days=i), float(i % 50 == k)) for k in range(3) for i in range(400)]
    daily = spark.createDataFrame(rows, "series_id string, date date, total_units double")
    ahead = daily.select("series_id", F.date_add("date", 400).alias("date"))
    given = spark.createDataFrame([("s0", 0, 0, 0.0, [0.0], [0.0], [0.0])], "series_id string, d int, sd int, intercept double, "
                                  "ar array<double>, ma array<double>, beta array<double>")
    for found, maps in ((ln.cross_products(daily, "total_units", [], ln.Grid()), 2), (ln.run_model(daily, given, ahead), 3)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == maps
        assert "x_ends" in plan[plan.index("hashpartitioning(series_id"):]


def test_few_windows_are_trained_in_one_part(spark, monkeypatch):
    """Each round of a fit sends the result of every part to the driver, however empty the part is."""
    parts = []

    class Counted(GBTRegressor):
        def fit(self, data):
            parts.append(data.rdd.getNumPartitions())
            return super().fit(data)

    monkeypatch.setattr(nl, "GBTRegressor", Counted)
    start = calendar_features(frame(spark, a=seasonal(120, 0))).withColumns({"avg_price": F.lit(1.0), "promo_any": F.lit(0)})
    nl.fit_nonlinear(start, "total_units", rounds=1, depth=1)
    assert parts == [1] * nl.N_OUT


def test_a_day_without_sales_never_leaves_spark_as_a_row(spark):
    """Counts of days and kept rows are packed: gaps, repeated days, rows without a day or a value and any order survive."""
    def day(i):
        return START + dt.timedelta(days=i)

    rows = [("plain", day(i), float(i % 90 == 0), None) for i in range(1500)]
    rows += [("gaps", day(i), float(i % 70 == 0), None) for i in range(900) if i % 7]
    rows += [("twice", day(i // 2), float(i % 50 == 0), float(i)) for i in range(300)]
    rows += [("undated", None, 4.0, None), ("undated", day(3), 0.0, None), ("undated", None, 0.0, 1.0)]
    rows += [("missing", day(i), None if i % 40 == 0 else 0.0, None) for i in range(200)]
    rows += [("old", dt.date(1960, 1, 1) + dt.timedelta(days=i), float(i in (0, 499)), None) for i in range(500)]
    rows += [(None, day(i), 0.0, None) for i in range(400)]
    df = spark.createDataFrame(rows[::-1], "series_id string, date date, x double, z0 double")

    def back(batches):
        for name, found in ln.unpacked_series(batches, "date"):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(found), pa.string()), *[found.column(c).combine_chunks() for c in ("date", "x", "z0")]],
                names=["series_id", "date", "x", "z0"])

    got = [tuple(r) for r in ln.by_series(ln.packed(df, {"z0": None}), "date").mapInArrow(back, df.schema).collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)
    for name in {r[0] for r in rows}:
        days = [r[1] for r in got if r[0] == name]
        assert days == sorted(days, key=lambda d: (d is not None, d))
    sent = df.sparkSession.createDataFrame([r for r in rows if r[0] == "plain"], df.schema)
    plan = ln.packed(sent, {"z0": None})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") == 2 and "<=>" in plan  # counts of days, and days of a value
    with pytest.raises(Exception, match="more than 15 rows"):
        ln.packed(spark.createDataFrame([("a", day(0), 0.0)] * 40, "series_id string, date date, x double")).collect()


def test_the_search_returns_one_row_a_series(spark):
    """The best candidate is found in the task: no candidate travels, and it is the one of the list."""
    df = frame(spark, a=seasonal(400, 1), b=arma(300, {1: 0.7}, {}, 2), c=[5.0] * 200, d=[1.0, 2.0])
    plan = ln.search_orders(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "MapInPandas" not in plan and "SortAggregate" not in plan
    best = {r["series_id"]: r for r in ln.search_orders(df).collect()}
    listed = {}
    for r in ln.candidate_models(df).collect():
        listed.setdefault(r["series_id"], []).append(r)
    assert set(best) == set("abcd") and set(listed) == set("ab")
    for name, rows in listed.items():
        least = min(rows, key=lambda r: (r["aic"], r["rank"]))
        assert best[name]["admissible"] == len(rows) and not best[name]["fallback"]
        assert [best[name][c] for c in ("d", "sd", "p", "q", "sp", "sq", "n")] == [least[c] for c in ("d", "sd", "p", "q", "sp", "sq", "n")]
        assert np.allclose(best[name]["ar"] + best[name]["ma"], least["ar"] + least["ma"])
    assert best["c"]["fallback"] and best["c"]["intercept"] == 5.0 and best["c"]["aic"] is None
    assert best["d"]["fallback"] and best["d"]["intercept"] == 1.5 and best["d"]["n"] == 2


@pytest.mark.parametrize("seed", [0, 1])
def test_side_by_side_solutions_are_those_of_least_squares(seed):
    """Also where columns are equal: those matrices leave the elimination."""
    rng, grid = np.random.default_rng(seed), ln.Grid()
    size = 2 + 2 * len(grid.all_lags)
    columns = rng.normal(size=(6, 200, size))
    columns[2, :, 5], columns[3, :, 4] = columns[2, :, 4], 0.0
    full = np.einsum("bti,btj->bij", columns, columns)
    d = np.array([0, 1, 0, 1, 0, 1])
    found = ln._candidates(full, np.full(6, 200), d, d, grid)
    for i, (p, q, sp, sq) in enumerate(grid.orders):
        for b in range(6):
            at = [*([1] if d[b] == 0 else []), *[2 + k for k, lag in enumerate(grid.all_lags) if lag in grid.lags(p, sp)],
                  *[2 + len(grid.all_lags) + k for k, lag in enumerate(grid.all_lags) if lag in grid.lags(q, sq)]]
            y, z = columns[b, :, 0], columns[b][:, at]
            left = y - z @ np.linalg.lstsq(z, y, rcond=None)[0] if at else y
            assert found["sse"][i, b] == pytest.approx(left @ left)


def test_the_calendar_is_not_written_where_the_observed_days_are(spark, tmp_path):
    from tidemark.operators.series import daily_series
    from tidemark.sources.registry import save_table

    rows = spark.createDataFrame([("a", START, 1, 2.0, 0), ("a", START + dt.timedelta(days=500), 3, 4.0, 1), ("b", START, 5, 6.0, 0)],
                                 "sku_id string, date date, units_sold long, price double, promotion_flag int")
    folder = str(tmp_path / "days")
    daily = daily_series(rows, "sku_id", lambda observed: save_table(observed, folder))
    assert spark.read.parquet(folder).count() == 3 and daily.count() == 502
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, daily_series(rows, "sku_id").collect()))
    assert "Exchange" not in daily._jdf.queryExecution().executedPlan().toString()
