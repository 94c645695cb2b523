"""spark-submit jobs/predict.py --input FILE --models FOLDER --out FOLDER [--by COLUMN]

One-step predictions of stored models over a new file."""

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark import build_session  # noqa: E402
from tidemark.plans.train import backtest_one_step  # noqa: E402
from tidemark.sources.sales import read_sales  # noqa: E402
from tidemark.sources.sinks import write_csv  # noqa: E402


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True)
    p.add_argument("--models", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--by", help="column that names the series; models must have been trained with it")
    a = p.parse_args()
    spark = build_session("predict")
    write_csv(backtest_one_step(read_sales(spark, a.input), a.models, a.by), a.out)


if __name__ == "__main__":
    main()
