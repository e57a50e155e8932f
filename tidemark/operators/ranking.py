"""Best row of each key by an explicit total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """Keep the first ``n`` rows of each key.

    ``order`` must end in a unique column for a repeatable result; give nulls a
    place with ``asc_nulls_last`` and the like.  Spark filters groups before it
    shuffles them, so hot keys cost ``n`` rows for each task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def top_struct(df: DataFrame, keys: Sequence[str], rank: Sequence[Column], values: Sequence[str], least: bool = False) -> DataFrame:
    """One aggregate instead of a sort: the values of the row with the greatest (or least) rank."""
    pick = (F.min if least else F.max)(F.struct(*(c.alias(f"_{i}") for i, c in enumerate(rank)), *values)).alias("_best")
    return df.groupBy(*keys).agg(pick).select(*keys, *(F.col(f"_best.{v}").alias(v) for v in values))


def mode_by(df: DataFrame, keys: Sequence[str], value: str, ties: Sequence[Column]) -> DataFrame:
    """The most frequent value of each key; ``ties`` (over value, ``n`` and ``first``) order equal counts, greatest first.

    ``df`` may have a column ``ord``; ``first`` is its smallest for the value.
    """
    first = F.min("ord") if "ord" in df.columns else F.lit(0)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), first.alias("first"))
    return top_struct(counts, keys, [F.col("n"), *ties], [value, "n"])


def placed(df: DataFrame, value: str, ties: Sequence[str]) -> DataFrame:
    """Add ``place``, from 1, by ``value`` and ``ties``, nulls first.

    Rows of a value are numbered apart and take the counts of smaller values, so
    no task has all rows; only the different values, which should be few, are
    numbered together.
    """
    counts = df.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_value", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    own = df.withColumn("_own", F.row_number().over(Window.partitionBy(value).orderBy(*ties)))
    return own.join(before, F.col(value).eqNullSafe(F.col("_value"))).withColumn("place", F.col("_before") + F.col("_own")).drop("_value", "_before", "_own")


def filled(columns: Sequence[str]) -> Column:
    """How many of the columns aren't null."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNotNull().cast("int")
    return total
