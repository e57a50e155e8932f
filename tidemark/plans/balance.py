"""Figures of a balance sheet or income statement that only its rows imply.

Rows are (filing_id, row_no, label, value), label in ``normal_label`` form and
empty for rows without one.  Every operator is one or two passes grouped by
filing; a filing's rows fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "filing_id"
NON_CURRENT = r"non.?current|property|equipment|goodwill|intangible|right.of.use|long.term|deferred tax|investment in"
LONG_DEBT = r"non.?current|long.term|deferred tax|lease liabilit.*non"


def _upto(order: str = "row_no") -> Window:
    return Window.partitionBy(KEY).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def _has(pattern: str) -> Column:
    return F.coalesce(F.col("label").rlike(f"(?i){pattern}"), F.lit(False))


def section_rows(rows: DataFrame, header: str, end: str) -> DataFrame:
    """The rows after the first that matches ``header`` and before the next that matches ``end``."""
    flagged = rows.withColumn("_open", F.max(_has(header).cast("int")).over(_upto()))
    flagged = flagged.withColumn("_stop", F.max((_has(end) & (F.col("_open") == 1) & ~_has(header)).cast("int")).over(_upto()))
    return flagged.where((F.col("_open") == 1) & (F.col("_stop") == 0) & ~_has(header)).drop("_open", "_stop")


def section_sum(rows: DataFrame, header: str, end: str) -> DataFrame:
    """(filing_id, n, total): the sum of absolute values of a section's labelled rows."""
    some = section_rows(rows, header, end).where("label <> '' and value is not null")
    return some.groupBy(KEY).agg(F.count("*").alias("n"), F.sum(F.abs("value")).alias("total"))


def section_subtotal(rows: DataFrame, header: str, end: str) -> DataFrame:
    """(filing_id, subtotal): the first positive value without a label in a section."""
    some = section_rows(rows, header, end).where("label = '' and value > 0")
    return some.groupBy(KEY).agg(F.min(F.struct("row_no", "value")).alias("m")).select(KEY, F.col("m.value").alias("subtotal"))


def current_by_order(rows: DataFrame, total: str, stop: str = NON_CURRENT) -> DataFrame:
    """(filing_id, current): the sum of positive rows before the first that isn't current, if that comes before the total."""
    marked = rows.withColumn("_end", F.max((_has(total) | _has(stop)).cast("int")).over(_upto()))
    kinds = rows.groupBy(KEY).agg(F.min(F.when(_has(stop), F.col("row_no"))).alias("stop"), F.min(F.when(_has(total), F.col("row_no"))).alias("total"))
    sums = marked.where("_end = 0 and value > 0").groupBy(KEY).agg(F.sum("value").alias("current"))
    return kinds.where("stop < total").join(sums, KEY).select(KEY, "current")


def current_by_rest(rows: DataFrame, total: str, stop: str = NON_CURRENT) -> DataFrame:
    """(filing_id, current): the total less all positive rows that aren't current, if that is between 0 and the total."""
    found = rows.groupBy(KEY).agg(
        F.max(F.when(_has(total), F.col("value"))).alias("total"),
        F.sum(F.when(_has(stop) & ~_has(total) & (F.col("value") > 0), F.col("value"))).alias("rest")
    )
    current = F.col("total") - F.col("rest")
    return found.where((current > 0) & (current < F.col("total"))).select(KEY, current.alias("current"))


def liabilities_by_order(rows: DataFrame, total: str = "total liabilities", stop: str = LONG_DEBT, apart: int = 3) -> DataFrame:
    """(filing_id, current): positive rows before the first that isn't current or that repeats a label at least ``apart`` rows on.

    Where neither occurs before the total, liabilities stand in order of liquidity and the total counts.
    """
    before = F.lag("row_no").over(Window.partitionBy(KEY, "label").orderBy("row_no"))
    marked = rows.withColumn("_again", (F.col("label") != "") & ~_has(total) & (F.col("row_no") - before >= apart))
    ends = marked.groupBy(KEY).agg(
        F.min(F.when(_has(stop) | F.coalesce("_again", F.lit(False)), F.col("row_no"))).alias("stop"),
        F.min(F.when(_has(total), F.col("row_no"))).alias("at"),
        F.max(F.when(_has(total), F.col("value"))).alias("total"),
    )
    sums = rows.join(ends, KEY).where("row_no < least(stop, at) and value > 0").groupBy(KEY).agg(F.sum("value").alias("part"))
    early = F.col("stop") < F.col("at")
    return ends.where("at is not null").join(sums, KEY, "left").select(
        KEY, F.when(early, F.col("part")).otherwise(F.col("total")).alias("current")
    ).where("current is not null")


def cost_of_revenue(rows: DataFrame) -> DataFrame:
    """(filing_id, cogs): the sum of ``cost of ... revenue`` rows, of which there are two at least and none is a total."""
    cost = _has(r"^cost of .*(?:revenue|sales)")
    whole = _has(r"^total cost|^cost of (?:revenues?|sales)$")
    found = rows.where(cost | whole).groupBy(KEY).agg(
        F.count_if(cost & ~whole).alias("n"), F.bool_or(whole).alias("whole"),
        F.sum(F.when(cost & ~whole, F.abs("value"))).alias("cogs")
    )
    return found.where("n >= 2 and not whole").select(KEY, "cogs")


def shares_of_classes(shares: DataFrame) -> DataFrame:
    """(filing_id, value) of (filing_id, share_class, value): the sum of the classes' different values, else the greatest without a class.

    Values that differ by no more than a billionth are the same.
    """

    def distinct(values: Column) -> Column:
        new = lambda seen, v: ~F.exists(seen, lambda s: F.abs(s - v) <= 1e-9 * F.greatest(F.abs(s), F.abs(v)))
        return F.aggregate(values, F.array().cast("array<double>"), lambda seen, v: F.when(new(seen, v), F.concat(seen, F.array(v))).otherwise(seen))

    some = shares.groupBy(KEY).agg(
        F.sort_array(F.collect_list(F.when(F.col("share_class").isNotNull(), F.col("value")))).alias("own"),
        F.max(F.when(F.col("share_class").isNull(), F.col("value"))).alias("general")
    )
    total = F.aggregate(distinct(F.col("own")), F.lit(0.0), lambda a, v: a + v)
    return some.select(KEY, F.when(F.size("own") > 0, total).otherwise(F.col("general")).alias("value"))


def class_sum_in_ads(facts: DataFrame, ratio: Column) -> DataFrame:
    """(filing_id, value) of (filing_id, share_class, value, ...): the greatest fact of each class, summed, in depositary shares."""
    each = facts.withColumn("_ratio", ratio).groupBy(KEY, "share_class").agg(F.max("value").alias("value"), F.max("_ratio").alias("_ratio"))
    return each.groupBy(KEY).agg((F.sum("value") / F.nullif(F.max("_ratio"), F.lit(0.0))).alias("value"))


def coverage(columns: list[str]) -> Column:
    """How many of the columns were found, as a share."""
    return sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0)) / F.lit(float(len(columns)))
