"""The job scripts as they are started, on small files."""

import runpy
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from tidemark.sources.registry import current_version

JOBS = Path(__file__).resolve().parents[1] / "jobs"


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    days = pd.date_range("2021-01-01", periods=200)
    rng = np.random.default_rng(1)
    rows = [(d.strftime("%Y-%m-%d"), sku, str(int(base + 20 * (i % 7) + rng.integers(0, 9))), 5.0 + i % 3, int(i % 5 == 0), "x")
            for sku, base, first in (("A", 100, 0), ("B", 40, 0), ("new", 10, 150)) for i, d in enumerate(days) if i >= first]
    table = pd.DataFrame(rows, columns=["date", "sku_id", "units_sold", "price", "promotion_flag", "note"])
    edge = "2021-06-20"
    table[table["date"] < edge].to_csv(root / "train.csv", index=False)
    table[table["date"] >= edge].to_csv(root / "test.csv", index=False)
    table.to_csv(root / "all.csv", index=False)
    messy = table.copy()
    messy.loc[messy.index[::10], "units_sold"] = ""
    messy.loc[messy.index[::7], "price"] = np.nan
    messy.loc[messy.index[3], "date"] = "junk"
    messy.to_csv(root / "messy.csv", index=False)
    return root, messy


def start(monkeypatch, name, *args):
    monkeypatch.setattr(sys, "argv", [name, *map(str, args)])
    runpy.run_path(str(JOBS / f"{name}.py"), run_name="__main__")


def table_of(spark, path):
    return spark.read.option("header", True).csv(str(path)).toPandas()


def test_train_forecast_and_predict_per_product(spark, files, monkeypatch):
    root, _ = files
    models = root / "models"
    start(monkeypatch, "train", "--train", root / "train.csv", "--test", root / "test.csv", "--out", models, "--rounds", 2, "--by", "sku_id")
    assert len(table_of(spark, models / "metrics.csv")) == 3
    per_series = spark.read.parquet(f"{current_version(spark, str(models))}/series/metrics").toPandas()
    assert set(per_series["series_id"]) == {"A", "B", "new"} and len(per_series) == 9
    out = root / "forecast"
    start(monkeypatch, "forecast", "--input", root / "all.csv", "--models", models, "--out", out, "--quarters", 1, "--as-of", "2021-08-10",
          "--by", "sku_id")
    daily = table_of(spark, out / "sku_daily")
    assert daily.groupby("SKU").size().to_dict() == {"A": 69, "B": 69, "new": 69}
    means = daily.assign(units=daily["Predicted Units"].astype(float)).groupby("SKU")["units"].mean()
    assert means["A"] > means["B"] > means["new"]
    start(monkeypatch, "predict", "--input", root / "all.csv", "--models", models, "--out", root / "predicted", "--by", "sku_id")
    assert set(table_of(spark, root / "predicted")["series_id"]) == {"A", "B", "new"}


def test_comparison_job(spark, files, monkeypatch):
    root, _ = files
    out = root / "compare"
    start(monkeypatch, "compare", "--train", root / "train.csv", "--test", root / "test.csv", "--out", out, "--rounds", 2, "--summary")
    assert set(table_of(spark, out / "metrics.csv")["model"]) == {"linear_regressors", "nonlinear_only"}
    assert "sigma2" in set(table_of(spark, out / "summary.csv")["term"]) and current_version(spark, str(out)) != str(out)


def test_exploration_takes_the_file_as_it_is(spark, files, monkeypatch):
    root, messy = files
    start(monkeypatch, "eda", "--input", root / "messy.csv", "--out", root / "eda")
    profile = dict(table_of(spark, root / "eda" / "messy" / "profile").to_numpy())
    assert profile["rows"] == str(len(messy)) and profile["columns"] == "6" and profile["nulls_date"] == "1"
    assert profile["nulls_units_sold"] == str((messy["units_sold"] == "").sum())
    assert profile["nulls_price"] == str(messy["price"].isna().sum())
    read = pd.read_csv(root / "messy.csv")
    dated = read[read["date"] != "junk"]
    want = dated.groupby("sku_id").agg(mean=("units_sold", "mean"), std=("units_sold", "std"), price=("price", "mean"), promo=("promotion_flag", "mean"))
    got = table_of(spark, root / "eda" / "messy" / "per_sku_summary").set_index("sku_id").astype(float)
    assert np.allclose(got.loc[want.index, ["mean_units", "std_units", "mean_price", "promo_frac"]], want, atol=6e-4)


def test_stationarity_job_skips_missing_quantities(spark, files, monkeypatch):
    root, _ = files
    start(monkeypatch, "stationarity", "--input", root / "messy.csv", "--out", root / "stationarity", "--max-lag", 10)
    read = pd.read_csv(root / "messy.csv")
    daily = read[read["date"] != "junk"].groupby("date")["units_sold"].sum().to_numpy()
    choice = table_of(spark, root / "stationarity" / "choice").iloc[0]
    values = daily if choice["use"] == "level" else np.diff(daily)
    centred = values - values.mean()
    acf = table_of(spark, root / "stationarity" / "acf").astype({"lag": int, "acf": float}).set_index("lag")["acf"]
    assert acf[1] == pytest.approx((centred[1:] * centred[:-1]).sum() / (centred ** 2).sum(), abs=1e-6)
