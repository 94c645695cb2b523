import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import eda, features as ft, horizon as hz, report as rp, series as sr
from tidemark.operators.align import missing_regressors, require_regressors


def day(text):
    return dt.date.fromisoformat(text)


def line(spark, values, start="2024-01-01", series="ALL"):
    rows = [(series, day(start) + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, date date, total_units long")


def sales(spark, rows):
    return spark.createDataFrame([(day(d), s, u, p, f) for d, s, u, p, f in rows],
                                 "date date, sku_id string, units_sold long, price double, promotion_flag int")


def test_densify_fills_gaps_per_series(spark):
    rows = sales(spark, [("2024-01-01", "A", 2, 10.0, 0), ("2024-01-04", "A", 3, 20.0, 1), ("2024-01-02", "B", 1, 5.0, 0)])
    got = sr.daily_series(rows, "sku_id").orderBy("series_id", "date").collect()
    assert [(r["series_id"], r["date"].day, r["total_units"], r["avg_price"], r["promo_any"]) for r in got] == [
        ("A", 1, 2, 10.0, 0), ("A", 2, 0, 10.0, 0), ("A", 3, 0, 10.0, 0), ("A", 4, 3, 20.0, 1), ("B", 2, 1, 5.0, 0)]
    assert got[0]["dow"] == 0


def test_fractional_sums_are_cut(spark):
    rows = sales(spark, [("2024-01-01", "A", 1, 1.0, 0)]).withColumn("units_sold", F.lit(7.9))
    assert sr.daily_series(rows).first()["total_units"] == 7


def test_price_is_filled_both_ways(spark):
    rows = spark.createDataFrame([("A", day(f"2024-01-0{i}"), p) for i, p in enumerate([None, 3.0, None, 4.0, None], 1)],
                                 "series_id string, date date, avg_price double")
    assert [r["avg_price"] for r in sr.fill_price(rows).orderBy("date").collect()] == [3.0, 3.0, 3.0, 4.0, 4.0]


def test_length_gate(spark):
    sr.validate_length(line(spark, [1] * 90), line(spark, [1] * 7))
    with pytest.raises(ValueError, match="training data too short"):
        sr.validate_length(line(spark, [1] * 89), line(spark, [1] * 7))
    with pytest.raises(ValueError, match="test data too short"):
        sr.validate_length(line(spark, [1] * 90), line(spark, [1] * 6))
    both = line(spark, [1] * 90).unionByName(line(spark, [1] * 5).withColumn("series_id", F.lit("short")))
    sr.validate_length(both, both)
    assert [(r["series_id"], r["n_days"]) for r in sr.short_series(both, 90).collect()] == [("short", 5)]


def test_window_counts(spark):
    daily = line(spark, range(100))
    pairs = ft.supervised_windows(daily, ["total_units"])
    assert pairs.count() == 100 - 30 - 7 + 1
    first = pairs.orderBy("date").first()
    assert [d[0] for d in first["x"]] == list(range(30)) and first["y"] == list(range(30, 37))
    split = ft.validation_split(pairs)
    assert split.filter("is_val").count() == 6
    assert split.filter("is_val").agg(F.min("date")).first()[0] > split.filter("not is_val").agg(F.max("date")).first()[0]
    assert ft.input_windows(daily, ["total_units"]).count() == 70
    few = ft.validation_split(ft.supervised_windows(line(spark, range(50)), ["total_units"]))
    assert few.count() == 14 and few.filter("is_val").count() == 0


def test_scaling_is_inverted_exactly_and_constants_survive(spark):
    daily = line(spark, [5, 5, 5]).withColumn("v", F.col("total_units") * 2.0)
    scaler = ft.fit_minmax(daily, ["v"])
    assert {r["v"] for r in ft.apply_scaler(daily, scaler, ["v"]).collect()} == {0.0}
    moving = line(spark, [1, 4, 9])
    std = ft.apply_scaler(moving, ft.fit_standard(moving, ["total_units"]), ["total_units"])
    row = std.agg(F.avg("total_units"), F.stddev_pop("total_units")).first()
    assert row[0] == pytest.approx(0, abs=1e-12) and row[1] == pytest.approx(1)


@pytest.mark.parametrize("quarters, days", [(2, 152), (8, 698), (1, 61)])
def test_horizon_of_the_recorded_runs(spark, quarters, days):
    ends = spark.createDataFrame([(day("2024-12-31"),)], "last_date date")
    row = hz.plan_horizon(ends, "2026-01-02", quarters).first()
    assert (row["days_to_skip"], row["forecast_days"], str(row["first_label"])) == (30, days, "2026-02-01")


@pytest.mark.parametrize("last, days", [("2024-12-31", 366), ("2022-04-30", 1342), ("2024-05-26", 585)])
def test_bridge_of_the_recorded_runs(spark, last, days):
    start = day(last) - dt.timedelta(days=2)
    history = line(spark, [1, 2, 3], start.isoformat()).withColumns({"avg_price": F.lit(1.0), "promo_any": F.lit(0)})
    assert hz.bridge_days(history, "2026-01-02").count() == days


def test_bridge_takes_the_nearest_day_of_last_year(spark):
    history = line(spark, list(range(430)), "2023-01-01").withColumns({"avg_price": F.lit(1.0), "promo_any": F.lit(0)})
    got = {str(r["date"]): r["total_units"] for r in hz.bridge_days(history, "2025-06-01").collect()}
    assert got["2024-03-06"] == (day("2023-03-06") - day("2023-01-01")).days
    assert got["2025-05-31"] == 429
    assert hz.bridge_gap(history, "2025-06-01").count() == (day("2025-06-01") - day("2023-01-01")).days


def test_shares(spark):
    rows = sales(spark, [("2024-01-01", "A", 90, 1.0, 0), ("2024-03-01", "B", 3, 1.0, 0), ("2024-03-02", "C", 1, 1.0, 0)])
    got = {r["sku_id"]: r["share"] for r in hz.sku_shares(rows).collect()}
    assert got == {"A": 0.0, "B": 0.75, "C": 0.25}
    quiet = rows.withColumn("units_sold", F.when(F.col("sku_id") == "A", F.col("units_sold")).otherwise(0))
    assert {r["sku_id"]: r["share"] for r in hz.sku_shares(quiet).collect()} == {"A": 1.0, "B": 0.0, "C": 0.0}
    none = rows.withColumn("units_sold", F.lit(0))
    assert all(r["share"] == pytest.approx(1 / 3) for r in hz.sku_shares(none).collect())


def test_allocation_keeps_the_total(spark):
    total = line(spark, [10, 20, 30]).select("date", F.col("total_units").cast("double").alias("predicted_units"))
    shares = spark.createDataFrame([("A", 0.25), ("B", 0.75)], "sku_id string, share double")
    got = hz.allocate(total, shares)
    assert got.count() == 6
    assert [r["s"] for r in got.groupBy("date").agg(F.sum("predicted_units").alias("s")).orderBy("date").collect()] == [10, 20, 30]


def test_centred_fortnight_runs_from_seven_before_to_six_after(spark):
    days = line(spark, range(40)).select(F.lit("A").alias("sku_id"), "date", F.col("total_units").cast("double").alias("predicted_units"))
    row = rp.centred_averages(days).filter("predicted_units = 20").first()
    assert row["ma14"] == sum(range(13, 27)) / 14 and row["ma7"] == 20


@pytest.mark.parametrize("n", [3, 500, 501, 564, 999, 1001, 1530])
def test_downsample_follows_float_edges(spark, n):
    days = line(spark, [(i * 37) % 101 for i in range(n)]).select(
        F.lit("A").alias("sku_id"), "date", "total_units").withColumnRenamed("total_units", "predicted_units").withColumns(
        {"ma7": F.col("predicted_units") / 4, "ma14": F.lit(None).cast("double")})
    got = [(r["date"], r["predicted_units"]) for r in rp.downsample(days).orderBy("date").collect()]
    data = [(r["date"], r["predicted_units"]) for r in days.orderBy("date").collect()]
    want = data
    if n > 500:
        edges = [int(i * (n / 500)) for i in range(501)]
        chunks = [data[a:min(b, n)] for a, b in zip(edges, edges[1:])]
        want = [(c[len(c) // 2][0], max(v for _, v in c)) for c in chunks if c]
    assert got == want
    if n <= 500:  # unchanged, averages too
        assert sorted(map(tuple, rp.downsample(days).select(days.columns).collect())) == sorted(map(tuple, days.collect()))


def test_histogram_of_a_constant(spark):
    days = line(spark, [4, 4]).select(F.lit("A").alias("sku_id"), "date", F.col("total_units").cast("double").alias("predicted_units"))
    rows = rp.histogram(days).orderBy("bin").collect()
    assert len(rows) == 15 and rows[0]["n"] == 2 and rows[0]["label"] == "4-5" and sum(r["n"] for r in rows) == 2


def test_histogram_keeps_rows_without_product(spark):
    rows = [(None, 1.0), (None, 16.0), ("A", 2.0), ("A", 2.0), ("C", -15.0), ("C", 0.0)]
    days = spark.createDataFrame(rows, "sku_id string, predicted_units double")
    got = {}
    for r in rp.histogram(days).collect():
        got.setdefault(r["sku_id"], []).append((r["bin"], r["label"], r["n"]))
    assert set(got) == {None, "A", "C"} and all(len(v) == 15 for v in got.values())
    filled = {k: [b for b in sorted(v, key=lambda b: b[0]) if b[2]] for k, v in got.items()}
    assert filled == {None: [(0, "1-2", 1), (14, "15-16", 1)], "A": [(0, "2-3", 2)], "C": [(0, "-15--14", 1), (14, "-1-0", 1)]}


def test_prices_are_filled_as_on_the_whole_calendar(spark):
    """Filling the observed days and handing the price on equals filling the dense calendar, missing days and prices included."""
    rows = spark.createDataFrame([
        (None, "A", 9, 99.0, 1), (day("2024-01-02"), "A", 1, None, 0), (day("2024-01-05"), "A", 2, 7.0, None),
        (day("2024-01-05"), "A", 2, 9.0, 1), (day("2024-01-08"), "A", None, None, 0), (day("2024-01-11"), "A", 1, 3.0, 0),
        (day("2024-01-01"), "B", 1, None, 0), (day("2024-01-04"), "B", 1, None, 1), (None, "C", 1, 5.0, 0),
        (day("2024-01-01"), None, 4, 2.0, 0), (day("2024-01-03"), None, 4, None, 0)],
        "date date, sku_id string, units_sold long, price double, promotion_flag int")
    whole = sr.fill_price(sr.densify_calendar(sr.daily_aggregate(sr.with_series(rows, "sku_id"))))
    got = sr.daily_series(rows, "sku_id").select(whole.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert [r["avg_price"] for r in got.filter("series_id = 'A'").orderBy("date").collect()] == [8.0] * 9 + [3.0]


def test_summary_of_one_row_has_no_deviation(spark):
    row = eda.per_sku_summary(sales(spark, [("2024-01-01", "A", 3, 1.0, 1)])).first()
    assert row["std_units"] is None and row["promo_frac"] == 1.0
    lift = eda.promo_lift(sales(spark, [("2024-01-01", "A", 3, 1.0, 1)])).first()
    assert lift["mean_no_promo"] is None and lift["relative_lift"] is None
    free = eda.promo_lift(sales(spark, [("2024-01-01", "A", 0, 1.0, 0), ("2024-01-01", "A", 3, 1.0, 1)])).first()
    assert free["relative_lift"] is None


def test_sample_keeps_small_products_whole_and_repeats(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 40, "small").otherwise("big").alias("sku_id"), "id")
    first = eda.sample_per_sku(rows, ["id"], size=1000)
    assert {r["sku_id"]: r["count"] for r in first.groupBy("sku_id").count().collect()} == {"small": 40, "big": 1000}
    again = eda.sample_per_sku(rows.repartition(7), ["id"], size=1000, spread=3)
    assert {r["id"] for r in first.collect()} == {r["id"] for r in again.collect()}
    other = eda.sample_per_sku(rows, ["id"], size=1000, seed=1)
    assert {r["id"] for r in first.collect()} != {r["id"] for r in other.collect()}


def test_regressor_gate(spark):
    days = line(spark, [1, 2, 3])
    assert missing_regressors(days, days).count() == 0
    with pytest.raises(ValueError, match="no regressors"):
        require_regressors(days, days.filter("total_units < 3"))


def test_legacy_split_day(spark):
    train, test = eda.split_by_date(line(spark, range(4), "2023-12-30"), "2024-01-01")
    assert (train.count(), test.count()) == (2, 2)
