"""spark-submit jobs/train.py --train TRAIN --test TEST --out FOLDER [--run-id ID] [--by COLUMN]

Trains on two sales files, stores the models under the folder and writes metrics.csv there."""

import argparse
import datetime as dt
import sys
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark import build_session  # noqa: E402
from tidemark.plans.train import Settings, train  # noqa: E402
from tidemark.sources.sinks import write_csv  # noqa: E402


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--train", required=True)
    p.add_argument("--test", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--run-id", default=uuid.uuid4().hex)
    p.add_argument("--by", help="column that names the series; one total series when left out")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--rounds", type=int, default=20)
    a = p.parse_args()
    spark = build_session("train")
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    metrics = train(spark, a.train, a.test, a.out, a.run_id, now, Settings(seed=a.seed, rounds=a.rounds), a.by)
    write_csv(metrics, f"{a.out}/metrics.csv")
    metrics.show(truncate=False)


if __name__ == "__main__":
    main()
