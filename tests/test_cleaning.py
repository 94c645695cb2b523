import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import coerce
from tidemark.functions.coerce import coerce_price, coerce_promo, coerce_units, parse_dates
from tidemark.functions.quantiles import exact_quantiles
from tidemark.functions.rounding import half_even, units_from_forecast
from tidemark.operators.clean import clip_iqr, filter_status, iqr_cap


def column(df, name):
    return [r[name] for r in df.collect()]


def test_units(spark):
    df = spark.createDataFrame([(t,) for t in ["3", "x", None, "2.9", "-1.7", "3d", "NaN", " 4 ", "1e2"]], "u string")
    assert column(coerce_units(df, "u"), "u") == [3, 1, 1, 2, -1, 1, 1, 4, 100]
    numbers = spark.createDataFrame([(2.9,), (None,), (float("nan"),)], "u double")
    assert column(coerce_units(numbers, "u"), "u") == [2, 1, 1]


def test_price(spark):
    df = spark.createDataFrame([("1.5",), ("",), (None,), ("abc",)], "p string")
    assert column(coerce_price(df, "p"), "p") == [1.5, 100.0, 100.0, 100.0]


@pytest.mark.parametrize("cells, want", [
    (["0", "abc", None], [1, 1, 0]),
    (["0", "1", None, None], [0, 1, 0, 0]),
    (["True", "False"], [1, 0]),
    (["True", "False", None], [1, 1, 0]),
    ([None, None], [0, 0]),
])
def test_promo_is_decided_per_column(spark, cells, want):
    df = spark.createDataFrame([(c,) for c in cells], "f string").coalesce(1)
    assert column(coerce_promo(df, "f"), "f") == want


def test_promo_of_typed_columns(spark):
    assert column(coerce_promo(spark.createDataFrame([(True,), (None,)], "f boolean"), "f"), "f") == [1, 0]
    assert column(coerce_promo(spark.createDataFrame([(1.0,), (None,)], "f double"), "f"), "f") == [1, 0]


@pytest.mark.parametrize("text, day", [
    ("04-30-22", "2022-04-30"), ("2022-04-30", "2022-04-30"), ("2022/04/30", "2022-04-30"),
    ("30/04/2022", "2022-04-30"), ("20220430", "2022-04-30"), ("Apr 30 2022", "2022-04-30"),
    ("4/5/2022", "2022-04-05"), ("04-30-95", "1995-04-30"), ("04-30-75", "2075-04-30"),
    ("04-30-76", "1976-04-30"), ("2022-04-30 10:11:12", "2022-04-30"), ("2022-04-30T10:11:12Z", "2022-04-30"),
    ("April 30, 2022", "2022-04-30"), ("30 Apr 2022", "2022-04-30"),
    ("30-Apr-22", "2022-04-30"), ("30-Apr-2022", "2022-04-30"), ("Apr-30-2022", "2022-04-30"), ("2022.04.30", "2022-04-30"),
    ("30.04.2022", "2022-04-30"), ("04/30/2022 10:30 PM", "2022-04-30"), ("2022-04-30 12:00:00 AM", "2022-04-30"),
    ("Sat, 30 Apr 2022", "2022-04-30"), ("Saturday, April 30, 2022", "2022-04-30"), ("2022-04", "2022-04-01"),
    ("0022-04-30", None), ("1677-09-21", None), ("1677-09-22", "1677-09-22"), ("2262-04-12", None), ("30-Abc-22", None),
    ("junk", None), ("13/13/2022", None), ("02/30/2022", None), ("", None), (None, None)])
def test_dates(spark, text, day):
    got = parse_dates(spark.createDataFrame([(text,)], "date string")).collect()
    assert [str(r["date"]) for r in got] == ([day] if day else [])


def test_status(spark):
    df = spark.createDataFrame([(" Shipped ",), ("Pending",), (None,), ("DELIVERED",)], "status string")
    assert column(filter_status(df), "status") == [" Shipped ", "DELIVERED"]
    bare = spark.createDataFrame([(1,)], ["x"])
    assert filter_status(bare) is bare


def test_cap(spark):
    few = spark.createDataFrame([(v,) for v in range(9)] + [(500,)], "units_sold long")
    assert iqr_cap(few).first()["cap"] is None
    assert max(column(clip_iqr(few), "units_sold")) == 500
    more = spark.createDataFrame([(v,) for v in [1, 2, 3, 50] * 3], "units_sold long")
    cap = iqr_cap(more).first()["cap"]
    values = [1, 2, 3, 50] * 3
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert cap == q3 + 1.5 * (q3 - q1)
    assert max(column(clip_iqr(more), "units_sold")) == min(50, cap)
    assert sorted(column(clip_iqr(more, cap=7.5), "units_sold"))[-1] == 7.5


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-5, 5), st.integers(-10 ** 9, 10 ** 9)), min_size=1, max_size=60))
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    row = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0]).first()
    assert row["n"] == len(values)
    assert row["quantiles"] == pytest.approx(list(np.quantile(values, [0, 0.25, 0.5, 0.75, 1])), rel=1e-12, abs=1e-6)


def test_quantiles_with_a_heavy_value(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("v"))
    values = [r["v"] for r in df.collect()]
    assert exact_quantiles(df, "v", [0.25, 0.75]).first()["quantiles"] == list(np.quantile(values, [0.25, 0.75]))


def test_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-3.2,)], "x double")
    assert column(df.select(half_even("x").alias("x")), "x")[:3] == [0.0, 2.0, 2.0]
    assert column(df.select(units_from_forecast("x").alias("x")), "x") == [0, 2, 2, 0]
    assert df.select(half_even(F.lit(0.25), 1)).first()[0] == 0.2


def test_numbers_beyond_their_type_count_as_unreadable(spark):
    rows = [("1e30", "3e12", "5", "2024-01-01"), ("3", "1", "x", "junk"), (None, "0", None, None), ("2.9", "1", "1e400", "2024-02-30")]
    df = spark.createDataFrame(rows, "units_sold string, promotion_flag string, price string, date string")
    assert [r.units_sold for r in coerce.coerce_units(df).collect()] == [1, 3, 1, 2]
    assert [r.promotion_flag for r in coerce.coerce_promo(df).collect()] == [0, 1, 0, 1]
    doubles = spark.createDataFrame([(1e30,), (2.5,), (None,)], "units_sold double")
    assert [r.units_sold for r in coerce.coerce_units(doubles).collect()] == [1, 2, 1]
    assert [r.promotion_flag for r in coerce.coerce_promo(doubles.withColumnRenamed("units_sold", "promotion_flag")).collect()] == [0, 2, 0]
    listed = sorted(tuple(r) for r in coerce.unreadable_cells(df).collect())
    assert listed == [("date", "2024-02-30", 1), ("date", "junk", 1), ("price", "x", 1), ("promotion_flag", "3e12", 1), ("units_sold", "1e30", 1)]
    assert coerce.unreadable_cells(df.select(df.date.alias("other"))).collect() == []
