"""Levinson-Durbin recursion (Yule-Walker equations) as an array expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.let import let


def levinson(acf: Column, order: int) -> Column:
    """``acf`` holds r0 = 1, r1..rK, K >= order. Returns struct(phi, v, pacf).

    ``phi`` are the autoregressive coefficients of the given order, ``v`` the share of variance
    left, ``pacf`` the partial autocorrelations at lags 1..order.
    """
    empty = F.array().cast("array<double>")
    start = F.struct(empty.alias("phi"), F.lit(1.0).alias("v"), empty.alias("pacf"))

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        known = F.aggregate(
            F.zip_with(phi, F.reverse(F.slice(acf, F.lit(2), k - 1)), lambda a, r: a * r),
            F.lit(0.0), lambda s, x: s + x)
        kappa = F.when(state["v"] > 1e-12, (F.element_at(acf, k + 1) - known) / state["v"]).otherwise(0.0)
        return let(kappa, lambda c: F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda a, b: a - c * b), F.array(c)).alias("phi"),
            (state["v"] * (1 - c * c)).alias("v"),
            F.concat(state["pacf"], F.array(c)).alias("pacf")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(order)), start, step)
