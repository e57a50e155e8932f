"""Lookups, cascades and set operations on keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cascade(key: str, value: str, *sources: DataFrame) -> DataFrame:
    """The value of the first source that has the key, over all keys."""
    every = None
    for i, s in enumerate(sources):
        one = s.where(F.col(value).isNotNull()).select(key, F.lit(i).alias("_source"), value)
        every = one if every is None else every.unionByName(one)
    return every.groupBy(key).agg(F.min(F.struct("_source", value)).alias("m")).select(
        key, F.col(f"m.{value}").alias(value), F.col("m._source").alias("source")
    )


def union_missing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All of ``left``, and the rows of ``right`` whose key isn't there, one for each key; a null equals a null."""
    there = left.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.unionByName(right.join(there, same, "left_anti").dropDuplicates(list(keys)))


#: Rows of a dictionary of patterns that every row may be compared with.
MOST_PATTERNS = 2000
#: Characters of a label that rows are looked up by.
GRAM = 8
#: A dictionary of up to so many rows and bytes of labels goes to every task, so that the rows stay where they are.
SMALL_ROWS, SMALL_BYTES = 10_000, 1 << 20


def matched_labels(rows: DataFrame, labels: DataFrame, how: str, text: str = "label", target: str = "target") -> DataFrame:
    """Rows with every dictionary label that matches: ``contains``, ``equals``, ``prefix`` or ``regex``.

    All but ``regex`` are joins by key, whatever the size of the dictionary.  For
    ``prefix`` a row is looked up by its beginnings of all lengths that labels
    have; for ``contains`` by its runs of characters as long as a label's first
    eight, or the whole of shorter labels, and then compared.  Those are many times
    the rows, which Spark's estimate doesn't see, so they never are sent whole to
    anyone: a small dictionary, which is counted, goes to them, and else both are
    joined by sorted runs.  Empty labels match every row, null ones none.  Patterns
    can't be looked up: ``regex`` compares each row with each of at most
    ``MOST_PATTERNS`` of them, which are counted.
    """
    t, l = F.col(text), F.col(target)
    if how == "equals":
        return rows.join(labels, t == l)
    if how == "regex":
        if labels.count() > MOST_PATTERNS:
            raise ValueError(f"a dictionary of patterns has at most {MOST_PATTERNS} rows")
        return rows.join(F.broadcast(labels), F.regexp_like(t, l))
    key = l if how == "prefix" else F.left(l, F.lit(GRAM))
    keyed = labels.withColumn("_key", key).where("_key is not null")
    lengths = keyed.groupBy(F.length("_key").alias("size")).agg(F.count("*").alias("n"), F.sum(F.octet_length(l)).alias("bytes")).collect()  # a few
    sizes = sorted(r.size for r in lengths)
    small = sum(r.n for r in lengths) <= SMALL_ROWS and sum(r.bytes for r in lengths) <= SMALL_BYTES
    keyed = F.broadcast(keyed) if small else keyed.hint("merge")
    size = F.explode(F.lit(sizes or [0]))
    if how == "prefix":
        looked = rows.withColumn("_size", size).where(F.length(t) >= F.col("_size")).withColumn("_key", F.substr(t, F.lit(1), F.col("_size")))
        return looked.join(keyed, "_key").drop("_key", "_size")
    if how != "contains":
        raise ValueError(how)

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(t) - n + 1, F.lit(1)))
        return F.when(F.length(t) >= n, F.transform(starts, lambda i: F.substr(t, i, F.lit(n)))).otherwise(F.array())

    looked = rows.withColumn("_key", F.explode(F.array_distinct(F.flatten(F.array(*map(runs, sizes or [0]))))))
    return looked.join(keyed, "_key").where(t.contains(l)).drop("_key")


def nearest(df: DataFrame, keys: Sequence[str], at: Column, target: Column, unique: Sequence[Column]) -> DataFrame:
    """The row of each key whose ``at`` is nearest to ``target``; ties by ``unique``."""
    gap = F.abs(at.cast("double") - target.cast("double"))
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(gap, *unique))).where("_r = 1").drop("_r")


def newer_of(left: DataFrame, right: DataFrame, key: str, date: str) -> DataFrame:
    """Full outer choice of two tables with one row for each key: the later date, ``left`` on ties."""
    a = left.select(key, F.col(date).alias("_a"), F.struct(*left.columns).alias("_l"))
    b = right.select(key, F.col(date).alias("_b"), F.struct(*right.columns).alias("_r"))
    pick = F.when(F.col("_b").isNull() | (F.col("_a") >= F.col("_b")), F.lit("left")).otherwise("right")
    return a.join(b, key, "full_outer").withColumn("side", pick).select(
        key, "side", F.when(F.col("side") == "left", F.col("_a")).otherwise(F.col("_b")).alias(date), "_l", "_r"
    )


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` put in place of those with the same key."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def overlaid(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both tables' keys, with the values of ``right`` where it has them, else those of ``left``; one row for each key in either."""
    values = [c for c in left.columns if c not in keys]
    a, b = left.select(*keys, F.struct(*values).alias("_l")), right.select(*keys, F.struct(*values).alias("_r"))
    return a.join(b, list(keys), "full_outer").select(*keys, *(F.coalesce(F.col(f"_r.{v}"), F.col(f"_l.{v}")).alias(v) for v in values))


def by_priority(
    candidates: DataFrame, keys: Sequence[str], source: str, value: str, order: Sequence[str],
    guard: tuple[float, float] | None = None
) -> DataFrame:
    """The value of the best source of each key, by ``order``; other sources and nulls don't count.

    With a ``guard`` the best value must lie within these multiples of the next
    source's; if not, the next source counts, if there is one.
    """
    rank = F.array_position(F.lit(list(order)), F.col(source))
    some = candidates.where((rank > 0) & F.col(value).isNotNull()).groupBy(*keys, source).agg(
        F.min(F.struct(rank.alias("rank"), F.col(value).alias("value"))).alias("c")
    )
    ranked = some.groupBy(*keys).agg(F.sort_array(F.collect_list("c")).alias("_all"))  # at most one for each source
    first, second = F.get("_all", 0), F.get("_all", 1)
    pick = first
    if guard:
        low, high = guard
        pick = F.when(second.isNotNull() & ~first["value"].between(second["value"] * low, second["value"] * high), second).otherwise(first)
    return ranked.withColumn("_p", pick).select(
        *keys, F.col("_p.value").alias(value), F.get(F.lit(list(order)), F.col("_p.rank").cast("int") - 1).alias(source)
    )


def first_of_siblings(rows: DataFrame, group: str, key: str, order: Sequence[str], value: str, most: int = 8) -> DataFrame:
    """For each row the first value that isn't null among the first ``most`` other rows of its group; rows without one are left out."""
    rank = Window.partitionBy(group).orderBy(*order)
    # The first ``most + 1`` of a group hold everyone's first ``most`` others.
    top = rows.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= most + 1).select(
        group, F.col(key).alias("_other"), "_n", F.col(value).alias("_v")
    )
    pairs = rows.select(group, key).join(top, group).where(F.col("_other") != F.col(key))
    near = pairs.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy("_n"))).where(F.col("_k") <= most)
    return near.where("_v is not null").groupBy(key).agg(F.min(F.struct("_k", "_v")).alias("m")).select(key, F.col("m._v").alias(value))


def overridden(rows: DataFrame, known: DataFrame, key: str, value: str) -> DataFrame:
    """``rows`` with a fixed value, by key, where they have none; ``known`` has one row for each key."""
    fixed = known.select(key, F.col(value).alias("_known"))
    return rows.join(fixed, key, "left").withColumn(value, F.coalesce(value, "_known")).drop("_known")


def without_keys(table: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A keyed table after a delete."""
    return table.join(gone.select(*keys).distinct(), list(keys), "left_anti")
