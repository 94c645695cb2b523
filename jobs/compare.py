"""spark-submit jobs/compare.py --train TRAIN --test TEST --out FOLDER [--by COLUMN] [--no-models] [--summary]

The linear model with regressors against the nonlinear model alone: metrics.csv, stored models, and on
request the coefficients of the linear model with their errors."""

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark import build_session  # noqa: E402
from tidemark.plans.ingest import load_series  # noqa: E402
from tidemark.plans.train import Settings, compare_models  # noqa: E402
from tidemark.sources.sinks import write_csv  # noqa: E402


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--train", required=True)
    p.add_argument("--test", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--by", help="column that names the series; one total series when left out")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--rounds", type=int, default=20)
    p.add_argument("--no-models", action="store_true", help="do not store the nonlinear model")
    p.add_argument("--summary", action="store_true", help="write the table of the linear coefficients")
    a = p.parse_args()
    spark = build_session("compare")
    days = [load_series(spark, path, by=a.by) for path in (a.train, a.test)]
    metrics, summary = compare_models(*days, a.out, Settings(seed=a.seed, rounds=a.rounds), not a.no_models)
    write_csv(metrics, f"{a.out}/metrics.csv")
    if a.summary:
        write_csv(summary, f"{a.out}/summary.csv")
    metrics.show(truncate=False)


if __name__ == "__main__":
    main()
