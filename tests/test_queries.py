"""Every registered query against its SQL counterpart, and the shape of its plan."""

import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.catalog import ORACLES, QUERIES

MODEL_QUERIES = {n for n in QUERIES if n not in ORACLES}


@pytest.fixture(scope="module")
def tables(sf):
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    yield con
    con.close()


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or abs(a - b) <= 2e-6 * max(1.0, abs(a))
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf, tables):
    df = QUERIES[name](spark, sf)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    cursor = tables.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = ordered(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want)
    assert all(same(a, b) for g, w in zip(got, want) for a, b in zip(g, w))


# Queries that solve small linear systems (a matrix or a series a row) in Arrow batches, or run on trained trees.
SOLVES_IN_PYTHON = {"t01_adf_test_no_lags", "m01_autoregressive_candidate", "m03_coefficient_table", "m04_forecast_linear_parts",
                    "m04_forecast_given_coefficients", "m05_apply_given_coefficients", "t01_adf_test", "t01_adf_test_seven_lags",
                    "t01_adf_test_walks", "t04_differencing_choice", "m07_forecast_blocks_given_trees",
                    "m08_predict_one_step_given_trees", "m09_forecast_future_given_trees"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_plan_has_no_product_join_and_no_python(name, spark, sf):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    if name not in SOLVES_IN_PYTHON:
        for bad in ("BatchEvalPython", "ArrowEvalPython", "InPandas", "InArrow"):
            assert bad not in plan


def test_scan_reads_only_needed_columns(spark, sf):
    plan = QUERIES["a04_daily_total"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    columns = set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<(.*?)>", plan))))
    assert columns == {"l_partkey", "l_quantity", "l_shipdate", "p_partkey"}


def test_product_filter_reaches_the_scan(spark, sf):
    plan = QUERIES["p08_filter_sku"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_brand,Brand#13)" in plan


def test_sample_is_limited_before_the_shuffle(spark, sf):
    plan = QUERIES["o04_sample_per_sku"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4


def test_series_are_shuffled_once_after_aggregation(spark, sf):
    plan = QUERIES["daily_series_per_part"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", ["daily_series_total", "o01_order_rows", "a17_variant_summary", "o04_sample_per_sku", "s10_row_count"])
def test_parts_are_not_sent_through_the_driver(name, spark, sf):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


@pytest.mark.parametrize("name, sorts", [("daily_series_per_part", 1), ("a12_histogram_parts", 3)])
def test_only_observed_days_are_sorted(name, sorts, spark, sf):
    """The gap-free days stream through: nothing above their generator sorts them or puts them in a window."""
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == plan.count("Window [") == plan.count("Generate explode") == sorts
    assert not re.search(r"(Sort|Window) \[", plan[:plan.index("Generate explode")])


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 2499
    assert {"series_id", "date", "total_units", "avg_price", "promo_any", "dow"} <= set(df.columns)


def test_every_query_has_a_kind():
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) > 75
