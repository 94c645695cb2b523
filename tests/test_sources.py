import pytest
from pyspark.sql import functions as F

from tidemark.operators.report import centred_averages, rounded_forecast
from tidemark.plans.ingest import clean_sales, ingest, load_series, raw_history
from tidemark.schema import NARROW_ALIASES, NA_TOKENS, WIDE_ALIASES
from tidemark.sources import registry, sales, sinks


@pytest.fixture
def report(tmp_path):
    path = tmp_path / "report.csv"
    path.write_text(
        "Order , Date ,Status,SKU,Category,Qty,Amount,promotion-ids\n"
        "1,04-30-22,Shipped,A,kurta,3,10.5,\n"
        "2,05-01-22, shipped ,A,kurta,x,,PROMO\n"
        "3,05-03-22,Delivered,B,set,NA,7,\"one, two\"\n"
        "4,05-03-22,Cancelled,B,set,9,7,\n"
        "5,junk,Shipped,B,set,2,7,\n")
    return str(path)


def test_read_headers_and_missing_cells(spark, report):
    df = sales.normalize_headers(sales.read_sales(spark, report))
    assert df.columns == ["order", "date", "status", "sku", "category", "qty", "amount", "promotion-ids"]
    rows = {r["order"]: r for r in df.collect()}
    assert rows["3"]["qty"] is None and rows["1"]["promotion-ids"] is None
    assert rows["3"]["promotion-ids"] == "one, two"


def test_na_tokens_become_null(spark):
    df = spark.createDataFrame([(t,) for t in NA_TOKENS] + [("0",)], "c string")
    assert [r["c"] for r in sales.blank_missing(df).filter("c is not null").collect()] == ["0"]


def test_first_alias_wins_and_the_rest_keep_their_names(spark, report):
    df = sales.apply_aliases(sales.normalize_headers(sales.read_sales(spark, report)))
    assert {"sku_id", "category", "units_sold", "price", "promotion_flag"} <= set(df.columns)
    assert "category" not in NARROW_ALIASES["sku_id"] and "status" not in NARROW_ALIASES
    assert "category" in WIDE_ALIASES["sku_id"]


def test_repeated_headers_stay_apart(spark):
    df = spark.createDataFrame([(1, 2)], ["Date", "Qty"]).toDF("Date", "date ")
    assert sales.normalize_headers(df).columns == ["date", "date_2"]


def test_missing_date_is_refused(spark):
    with pytest.raises(ValueError, match="missing columns .*date"):
        sales.canonical_columns(spark.createDataFrame([(1,)], ["qty"]))


def test_history_needs_units(spark):
    with pytest.raises(ValueError, match="units_sold"):
        sales.history_columns(spark.createDataFrame([("2024-01-01",)], ["ds"]))


def test_cleaning_of_a_marketplace_report(spark, report):
    rows = {str(r["date"]): r for r in clean_sales(sales.read_sales(spark, report)).collect()}
    assert sorted(rows) == ["2022-04-30", "2022-05-01", "2022-05-03"]
    assert rows["2022-05-01"]["units_sold"] == 1 and rows["2022-05-01"]["price"] == 100.0
    assert [rows[d]["promotion_flag"] for d in sorted(rows)] == [0, 1, 1]
    assert rows["2022-05-03"]["units_sold"] == 1


def test_series_of_a_file(spark, report):
    rows = load_series(spark, report).orderBy("date").collect()
    assert [r["total_units"] for r in rows] == [3, 1, 0, 1]
    assert [r["avg_price"] for r in rows] == [10.5, 100.0, 100.0, 7.0]
    only_b = load_series(spark, report, sku="B").collect()
    assert [r["total_units"] for r in only_b] == [1]


def test_two_column_series_gets_defaults(spark):
    df = spark.createDataFrame([("2024-01-01", "4"), ("2024-01-03", "6")], ["ds", "y"])
    rows = ingest(df).orderBy("date").collect()
    assert [(r["total_units"], r["avg_price"], r["promo_any"]) for r in rows] == [
        (4, 100.0, 0), (0, 100.0, 0), (6, 100.0, 0)]


def test_raw_history_is_not_cleaned(spark):
    df = spark.createDataFrame([("2024-01-01", "A", "5"), ("2024-01-01", "A", None)], ["date", "sku", "qty"])
    assert raw_history(df).agg(F.sum("units_sold")).first()[0] == 5.0


def test_forecast_export_layout(spark, tmp_path):
    days = spark.range(3).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit("A").alias("sku_id"), F.col("id").cast("double").alias("predicted_units"))
    out = sinks.forecast_export(rounded_forecast(centred_averages(days)).withColumn(
        "ma14", F.when(F.col("date") > "2024-01-01", F.col("ma14"))))
    sinks.write_csv(out, str(tmp_path / "export"))
    back = spark.read.option("header", True).csv(str(tmp_path / "export")).orderBy("Date").collect()
    assert back[0].asDict() == {"Date": "2024-01-01", "Predicted Units": "0", "MA7": "1.0", "MA14": None, "SKU": "A"}


def test_registry_returns_the_latest_run(spark, tmp_path):
    metrics = spark.createDataFrame([("hybrid", 2.0, 10.0), ("linear_only", 3.0, 11.0)], "model string, rmse double, mape double")
    folder = str(tmp_path / "runs")
    registry.record_run(metrics, "second", "2024-02-01 00:00:00", 1, 100, 20, folder)
    registry.record_run(metrics.withColumn("rmse", F.lit(9.0)), "first", "2024-01-01 00:00:00", 1, 90, 10, folder)
    row = registry.latest_metrics(spark, folder).first()
    assert row["run_id"] == "second" and row["metrics"]["hybrid_rmse"] == 2.0 and row["train_size"] == 100


def test_variant_sets(spark, tmp_path):
    rows = spark.createDataFrame([("A", "2023-12-31", 1), ("B", "2024-01-01", 2)], ["variant", "date", "units"])
    sinks.write_variant_sets(rows.filter("date < '2024-01-01'"), rows.filter("date >= '2024-01-01'"), str(tmp_path))
    assert spark.read.option("header", True).csv(str(tmp_path / "full")).count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "train")).first()["variant"] == "A"


def test_quoted_line_ends_do_not_split_a_record(spark, tmp_path):
    (tmp_path / "sales.csv").write_text('date,sku,note,qty\n2024-01-01,a,"two\nlines",3\n2024-01-02,b,"say ""x""",4\n')
    rows = sales.read_sales(spark, str(tmp_path / "sales.csv")).collect()
    assert [tuple(r) for r in rows] == [("2024-01-01", "a", "two\nlines", "3"), ("2024-01-02", "b", 'say "x"', "4")]
    assert sales.read_sales(spark, str(tmp_path / "sales.csv"), multi_line=False).count() == 3
