"""Exact quantiles whose cost per task does not grow with the table.

The built-in ``percentile`` gathers every distinct value of a group in one task. Here the
values are counted in parallel, the counts are folded into a fixed number of ordered buckets,
and only the buckets that hold a wanted rank are looked at value by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS_PER_E = 256


def _bucket(value: Column) -> Column:
    """Order-preserving bucket of a double; at most about 360,000 buckets exist."""
    size = F.floor(F.log1p(F.abs(value)) * BUCKETS_PER_E)
    return F.when(value < 0, -size - 1).otherwise(size)


def _rank(total: str, p: float, up: bool) -> Column:
    exact = F.lit(p) * (F.col(total) - 1)
    return F.ceil(exact) if up else F.floor(exact)


def exact_quantiles(df: DataFrame, value: str, probs: list[float], weight: str | None = None) -> DataFrame:
    """One row: ``n`` and ``quantiles`` (array, linear interpolation between ranks). ``weight``
    names a column that says how often each row counts."""
    times = F.col(weight) if weight else F.lit(1)
    counts = (df.select(F.col(value).cast("double").alias("v"), times.alias("n"))
              .filter("v is not null and n > 0").groupBy("v").agg(F.sum("n").alias("n"))
              .withColumn("b", _bucket(F.col("v"))))
    # One row per bucket: bounded by the bucket rule, so a single ordered task is fine.
    buckets = counts.groupBy("b").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("b")) - F.col("n")
    total = F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding,
                                                           Window.unboundedFollowing))
    placed = buckets.select("b", before.alias("before"), total.alias("total"))

    ranks = [_rank("total", p, up) for p in probs for up in (False, True)]
    wanted = placed.agg(
        F.max("total").alias("total"),
        *[F.max(F.when(F.col("before") <= rank, F.struct("before", "b"))).alias(f"hit{i}")
          for i, rank in enumerate(ranks)])
    target = wanted.select(F.struct("*").alias("w")).scalar()

    inside = Window.partitionBy("b").orderBy("v")
    hits = [F.col(f"w.hit{i}.b") for i in range(len(ranks))]
    fine = (counts.withColumn("w", target).filter(F.col("b").isin(*hits))
            .withColumn("upto", F.sum("n").over(inside)))
    picked = fine.agg(F.max("w.total").alias("total"), *[
        F.min(F.when((F.col("b") == F.col(f"w.hit{i}.b"))
                     & (F.col(f"w.hit{i}.before") + F.col("upto") > _rank("w.total", p, up)),
                     F.col("v"))).alias(f"v{i}")
        for i, (p, up) in enumerate((p, up) for p in probs for up in (False, True))])
    values = []
    for j, p in enumerate(probs):
        exact = F.lit(p) * (F.col("total") - 1)
        part = exact - F.floor(exact)
        lo, hi = F.col(f"v{2 * j}"), F.col(f"v{2 * j + 1}")
        values.append(lo + (hi - lo) * part)
    return picked.select(F.coalesce("total", F.lit(0)).alias("n"), F.array(*values).alias("quantiles"))
