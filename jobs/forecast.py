"""spark-submit jobs/forecast.py --input FILE --models FOLDER --out FOLDER [--quarters 4] [--as-of DAY] [--by COLUMN]

Forecast of the coming quarters: daily, quarterly and chart tables as CSV folders."""

import argparse
import datetime as dt
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from tidemark import build_session  # noqa: E402
from tidemark.plans.forecast import run_forecast  # noqa: E402
from tidemark.sources.sinks import forecast_export, write_csv  # noqa: E402


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True)
    p.add_argument("--models", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--quarters", type=int, default=4)
    p.add_argument("--as-of", default=dt.date.today().isoformat())
    p.add_argument("--by", help="column that names the series; models must have been trained with it")
    p.add_argument("--clean", action="store_true", help="product shares from cleaned rows")
    a = p.parse_args()
    spark = build_session("forecast")
    result = run_forecast(spark, a.input, a.quarters, a.as_of, a.models, a.clean, by=a.by)
    total = result.total_daily.withColumn("sku_id", F.lit("all"))
    for name, table in {
        "sku_daily": forecast_export(result.sku_daily), "total_daily": forecast_export(total),
        "sku_quarterly": result.sku_quarterly, "sku_points": result.sku_points,
        "total_points": result.total_points, "summary": result.summary,
    }.items():
        write_csv(table, f"{a.out}/{name}")


if __name__ == "__main__":
    main()
