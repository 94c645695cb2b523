"""spark-submit jobs/eda.py --input FILE [FILE ...] --out FOLDER [--split DAY]

Exploratory tables of a sales file; with several files a comparison of the variants as well."""

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark import build_session  # noqa: E402
from tidemark.plans.explore import explore, explore_variants  # noqa: E402
from tidemark.plans.ingest import raw_rows  # noqa: E402
from tidemark.sources.sales import read_sales  # noqa: E402
from tidemark.sources.sinks import write_csv, write_variant_sets  # noqa: E402


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True, nargs="+")
    p.add_argument("--out", required=True)
    p.add_argument("--split", default="2024-01-01")
    a = p.parse_args()
    spark = build_session("eda")
    variants = {Path(path).stem: raw_rows(read_sales(spark, path)) for path in a.input}
    for name, rows in variants.items():
        for table, df in explore(rows).items():
            write_csv(df, f"{a.out}/{name}/{table}")
    if len(variants) > 1:
        canonical = ["date", "sku_id", "units_sold", "price", "promotion_flag"]
        both = explore_variants({n: v.select(canonical).filter("date is not null") for n, v in variants.items()}, a.split)
        write_csv(both["summary"], f"{a.out}/variant_summary")
        write_variant_sets(both["train"], both["test"], f"{a.out}/sets")


if __name__ == "__main__":
    main()
