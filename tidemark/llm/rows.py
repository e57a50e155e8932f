"""Keys of a table's own rows, for operators whose ids may be null or repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

#: Key lists of at most so many rows, counted before, are broadcast.
MOST_KEYS = 1_000_000


def repeating(docs: DataFrame, id_col: str, nulls: bool = True) -> bool:
    """Whether an id repeats or, with ``nulls``, is null."""
    some = "n > 1 or k is null" if nulls else "n > 1 and k is not null"
    return docs.groupBy(F.col(id_col).cast("long").alias("k")).agg(F.count("*").alias("n")).where(some).limit(1).count() > 0


def numbered(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch, name: str = "_row") -> DataFrame:
    """``docs`` with a unique number in the order of the ids, null ids last; it is written, so that it stays."""
    key = F.col(id_col).cast("long")
    # The hash parts the texts of one id; of equal rows any order will do.
    order = [key.asc_nulls_last(), F.col("_hash"), F.col("_at")]
    hashed = docs.withColumn("_hash", F.xxhash64(text_col)).withColumn("_at", F.monotonically_increasing_id())
    placed = hashed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash", "_at")
    # The number holds the partition, in order of its range, above the place within.
    return scratch.keep(placed.withColumn(name, F.monotonically_increasing_id()), "placed")


def without(docs: DataFrame, key: str, gone: DataFrame, most: int = MOST_KEYS) -> DataFrame:
    """``docs`` without the keys in ``gone``; a list of at most ``most`` keys is broadcast, so that no text is shuffled."""
    keys = gone.select(key).distinct()
    return docs.join(F.broadcast(keys) if gone.count() <= most else keys, key, "left_anti")
