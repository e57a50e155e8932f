"""Ordered lines: sections, windows, look-ahead and carried labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import let


def numbered_lines(df: DataFrame, lines: Column, keep: Sequence[str]) -> DataFrame:
    """One row for each line of an array, with its place."""
    return df.select(*keep, F.posexplode(lines).alias("line_no", "line"))


def sections(df: DataFrame, keys: Sequence[str], order: str, start: Column, stop: Column | None = None) -> DataFrame:
    """Number the sections that ``start`` opens, 0 before the first; ``inside`` ends with the line before ``stop``."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("section", F.sum(F.coalesce(start, F.lit(False)).cast("int")).over(upto))
    if stop is None:
        return out
    within = Window.partitionBy(*keys, "section").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("inside", (F.col("section") > 0) & (F.sum(F.coalesce(stop, F.lit(False)).cast("int")).over(within) == 0))


def line_windows(lines: Column, most: int = 3) -> Column:
    """Every run of one to ``most`` lines as structs (at, n, text), joined by spaces; the array is computed once."""

    def runs(x: Column) -> Column:
        def run(k: int):
            return lambda _, i: F.struct(i.alias("at"), F.lit(k).alias("n"), F.array_join(F.slice(x, i + 1, k), " ").alias("text"))

        every = [F.transform(x, run(k)) for k in range(1, most + 1)]
        return F.filter(F.flatten(F.array(*every)), lambda w: w["at"] + w["n"] <= F.size(x))

    return let(lines, runs)


def carried(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """The last value that wasn't null, up to and with each row."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def looked_ahead(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int, name: str = "ahead") -> DataFrame:
    """The next ``n`` values as an array."""
    return df.withColumn(name, F.collect_list(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(1, n)))


def merged_parentheses(tokens: Column) -> Column:
    """Join a split ``(12`` and ``)`` into ``(12)``."""


    def merged(t: Column) -> Column:
        open_at = lambda x: x.startswith("(") & ~x.endswith(")")
        takes = lambda x, i: open_at(x) & F.coalesce(F.get(t, i + 1) == ")", F.lit(False))
        closed = F.transform(
            t,
            lambda x, i: F.when(takes(x, i), F.concat(x, F.lit(")"))).when(
                (x == ")") & (i > 0) & open_at(F.get(t, i - 1)), None
            ).otherwise(x)
        )
        return F.filter(closed, lambda x: x.isNotNull())

    return let(tokens, merged)


def last_match(df: DataFrame, keys: Sequence[str], order: str, matches: Column, late: Column) -> DataFrame:
    """The first matching row of each key, or the last where ``late`` holds for the key's rows."""
    some = df.where(matches).withColumn("_late", late)
    rank = F.when(F.col("_late"), -F.col(order)).otherwise(F.col(order))
    return some.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(rank))).where("_r = 1").drop("_r", "_late")


def values_after(df: DataFrame, keys: Sequence[str], order: str, label: Column, values: Column, n: int) -> DataFrame:
    """For each row where ``label`` holds, the values of the rows after it, up to ``n`` and up to the first without any."""
    ahead = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, n)
    marked = df.withColumn("_ahead", F.collect_list(F.coalesce(values, F.array().cast("array<double>"))).over(ahead)).where(label)
    stop = F.array_position(F.transform("_ahead", lambda v: F.size(v) == 0), F.lit(True))
    upto = F.when(stop > 0, F.slice("_ahead", 1, F.greatest(stop - 1, F.lit(0)).cast("int"))).otherwise(F.col("_ahead"))
    return marked.withColumn("found", F.flatten(upto)).drop("_ahead")
