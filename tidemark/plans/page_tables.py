"""The tables of filings as rows: one plan from markup to the best table of each kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import tables as T
from tidemark.functions.text import normal_label
from tidemark.session import once


@once
def _tables_of(html: str) -> tuple[Column, Column, Column, Column]:
    known = lambda g: F.struct(g.alias("grid"), T.table_kind(T.grid_text(g)).alias("kind"))
    # Generators: conditions on what they make are not copied below them, so a grid is made once.
    return (
        F.col(html).rlike(r"(?i)<table\b"), T.stated_units(F.col(html)).alias("stated"), F.inline(T.table_markups(F.col(html))),
        F.inline(F.transform(F.array(T.grid(F.col("markup"))), known))
    )


def page_tables(pages: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """One row for each table: ``keep``, stated (the page's units), idx, start, markup, grid and kind.

    A page that is null or has no table has no row.
    """
    some, stated, tables, grid = _tables_of(html)
    return pages.where(some).select(*keep, stated, tables).select(*keep, "stated", "idx", "start", "markup", grid)


@once
def _facts_of(fields: tuple[tuple[str, ...], ...]) -> tuple[dict[str, Column], ...]:
    grid = F.col("grid")
    has = lambda some: F.exists("labels", lambda x: _any(x.startswith(s) for s in some)).cast("int")
    first = {"rows": T.labelled_rows(grid), "evidence": T.unit_evidence(grid, F.col("markup"), F.col("start"), F.col("stated"))}
    second = {"labels": F.transform("rows", lambda r: normal_label(r["label"])), "best": F.array_min("evidence")}
    income = F.col("kind") == "IS"
    last = {
        "kind": F.col("kind"), "unit": F.col("best.unit"), "tier": T.tier_name(F.col("best.tier")),
        "reliability": T.reliability(F.col("best.tier")), "latest": T.latest_column(grid),
        "to_millions": F.try_element_at(F.create_map(*(F.lit(x) for p in T.UNITS.items() for x in p)), F.col("best.unit")), "n_rows": F.size("grid"),
        "rows": F.col("rows"), "exclusion": F.when(income, T.exclusion(grid)),
        "revenue": F.when(income, T.names_revenue(grid, F.transform("rows", lambda r: r["label"]))),
        "n_fields": F.when(income, sum((has(f) for f in fields), F.lit(0)))
    }
    return first, second, last


def table_facts(tables: DataFrame, keep: Sequence[str], fields: Sequence[Sequence[str]] = ()) -> DataFrame:
    """What each table says: kind, unit with tier and reliability, newest column, rows, and its rank as an income statement.

    ``fields`` are the labels of each income metric; ``n_fields`` counts the
    metrics that some row's label begins with; what concerns income statements
    is null for others.  Tables of no kind are left out.
    """
    first, second, last = _facts_of(tuple(map(tuple, fields)))
    known = tables.where("kind is not null").withColumns(first).withColumns(second)
    return known.select(*keep, "idx", *(c.alias(n) for n, c in last.items()))


def _any(tests) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def best_tables(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each key and kind the best table, by one aggregate.

    Balance sheets and cash flows: the most reliable unit, then the most rows.
    Income statements before that: no segment, reconciliation or non-GAAP
    table where there is another, in this order of reluctance; then tables
    that name revenue; after reliability the most metrics.  The first table
    wins ties.
    """
    income = F.col("kind") == "IS"
    rank = F.struct(
        F.when(income, F.col("exclusion")).otherwise(0).alias("a"), F.when(income, ~F.col("revenue")).otherwise(F.lit(False)).alias("b"),
        (-F.col("reliability")).alias("c"), F.when(income, -F.col("n_fields")).otherwise(0).alias("d"), (-F.col("n_rows")).alias("e"), F.col("idx").alias("f")
    )
    values = [c for c in facts.columns if c not in (*keys, "kind")]
    best = facts.groupBy(*keys, "kind").agg(F.min_by(F.struct(*values), rank).alias("t"))
    return best.select(*keys, "kind", "t.*")
