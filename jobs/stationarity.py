"""spark-submit jobs/stationarity.py --input FILE --out FOLDER [--max-lag 40] [--by COLUMN]"""

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark import build_session  # noqa: E402
from tidemark.plans.explore import stationarity_report  # noqa: E402
from tidemark.plans.ingest import raw_rows  # noqa: E402
from tidemark.sources.sales import read_sales  # noqa: E402
from tidemark.sources.sinks import write_csv  # noqa: E402


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--max-lag", type=int, default=40)
    p.add_argument("--by", help="column that names the series; one total series when left out")
    a = p.parse_args()
    spark = build_session("stationarity")
    rows = raw_rows(read_sales(spark, a.input))
    for name, table in stationarity_report(rows, a.by, a.max_lag).items():
        write_csv(table, f"{a.out}/{name}")


if __name__ == "__main__":
    main()
