"""Bind an intermediate value inside one expression.

Naming a value as a column is not enough where the optimizer may inline it again (it does below
a filter), and long inlined expressions outgrow what the JVM is willing to compile.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))
