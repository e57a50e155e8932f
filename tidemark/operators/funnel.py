"""Sequential gates, counted in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gate(stops: Sequence[tuple[str, Column]], passed: str = "passed") -> Column:
    """The name of the first stop whose condition holds, else ``passed``; an unknown condition doesn't stop."""
    out = F.lit(passed)
    for name, stop in reversed(stops):
        out = F.when(F.coalesce(stop, F.lit(False)), name).otherwise(out)
    return out


def funnel(df: DataFrame, names: Sequence[str], column: str = "gate") -> DataFrame:
    """One row: how many rows got past each stop and how many stopped there, by aggregates over ``column``."""
    return df.agg(F.count("*").alias("total"), *(F.count_if(F.col(column) == n).alias(n) for n in names))
