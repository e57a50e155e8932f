"""Repairs of figures whose scale was read wrongly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share counts at or above the first limit are single shares, above the second thousands; else they are millions.
SINGLE, THOUSANDS = 1e6, 1e4
#: How far earnings and shares may miss net income before the count is taken to be off by a thousand.
CROSS_CHECK = (100.0, 10_000.0)
#: Statement figures above this, said to be in millions, are thousands.
LARGE_MILLIONS = 1e5


def shares_in_millions(x: Column) -> Column:
    """A share count of unknown scale in millions, by its size."""
    a = F.abs(x)
    return F.when(a >= SINGLE, x / 1e6).when(a > THOUSANDS, x / 1e3).otherwise(x)


def cross_checked_shares(shares: Column, net_income: Column, eps: Column) -> Column:
    """A share count, times or over a thousand if net income by earnings a share says that it is off by about that."""
    implied = F.abs(net_income / F.nullif(eps, F.lit(0.0)))
    low, high = CROSS_CHECK
    return F.when(implied.between(shares * low, shares * high), shares * 1000).when(
        shares.between(implied * low, implied * high), shares / 1000
    ).otherwise(shares)


def inferred_unit(values: list[Column]) -> Column:
    """``thousands`` if the greatest of some figures of unknown unit is above 100,000, else ``millions``; null without figures."""
    some = [F.abs(v) for v in values]
    top = some[0] if len(some) == 1 else F.greatest(*some)
    return F.when(top > LARGE_MILLIONS, "thousands").when(top.isNotNull(), "millions")


def once_scaled(report: DataFrame, tokens: DataFrame, metrics: list[str], anchors: list[str], least: int = 2) -> DataFrame:
    """Divide the metrics of annual reports by 1,000 where at least ``least`` anchors stand in the text a thousand times smaller, and none as it is.

    ``report``: filing_id, form_type and the metrics; ``tokens``: filing_id and
    value, the figures of the text as written, in the text's own unit.
    """
    written = tokens.groupBy("filing_id").agg(F.collect_set("value").alias("_written"))
    both = report.join(written, "filing_id", "left")
    stands = lambda v: F.coalesce(F.array_contains("_written", v), F.lit(False)).cast("int")
    smaller = sum((stands(F.col(a) / 1000) for a in anchors), F.lit(0))
    same = sum((stands(F.col(a)) for a in anchors), F.lit(0))
    twice = F.coalesce(F.col("form_type").isin("10-K", "20-F"), F.lit(False)) & (smaller >= least) & (same == 0)
    return both.withColumn("_twice", twice).withColumns(
        {m: F.when(F.col("_twice"), F.col(m) / 1000).otherwise(F.col(m)) for m in metrics}
    ).drop("_written", "_twice")
