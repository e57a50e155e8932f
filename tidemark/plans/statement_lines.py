"""Statements in plain lines as rows: sections by gaps and islands, labels that wait, figures stacked under them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import lines as L
from tidemark.functions.numbers import let
from tidemark.session import once

#: Lines of a label at most, the last ones.
MOST_WAITING = 3


def _yes(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


@once
def _marks(lines: str) -> tuple:
    line = F.col("line")
    first = F.array_position(F.transform(lines, lambda x: _yes(L.title_kind(x).isNotNull())), F.lit(True)).cast("int")
    each = F.posexplode(F.expr(f"slice({lines}, first, size({lines}))")).alias("at", "raw")
    place = [(F.col("first") + F.col("at") - 1).alias("n"), L.closed_parentheses(F.col("raw")).alias("line")]
    read = {"kind": L.title_kind(line), "head": L.line_head(line), "dated": L.only_dates(line), "stops": line.rlike(L.STOP)}
    title = F.col("kind").isNotNull() & (F.length("line") < L.LONGEST_TITLE) & (F.size("tokens") == 0)
    last = {"stop": ~F.col("title") & F.col("stops"), "row": ~F.col("title") & ~F.col("stops") & (F.size("tokens") > 0) & ~F.col("dated")}
    return first.alias("first"), each, place, read, {"tokens": L.line_tokens(line, F.col("head"))}, {"title": title}, last


def marked_lines(filings: DataFrame, key: str, lines: str, keep: Sequence[str] = ()) -> DataFrame:
    """(key, *keep, n, line, kind, head, tokens, dated, title, stop, row) for each line from a filing's first title on."""
    first, each, place, *steps = _marks(lines)
    out = filings.select(key, *keep, first, lines).where("first > 0").select(key, *keep, "first", each).select(key, *keep, *place)
    for step in steps:
        out = out.withColumns(step)
    return out.drop("stops")


@once
def _section_steps(key: str) -> tuple:
    upto = Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    section = Window.partitionBy(key, "section")
    cut = F.col("title") | F.col("stop")
    prev = F.last(F.when(cut, F.struct("kind", "stop", "filled")), ignorenulls=True).over(before)
    opens = F.col("title") & (F.col("prev").isNull() | F.col("prev.stop") | (F.col("prev.kind") != F.col("kind")) | F.col("prev.filled"))
    steps = (
        {"part": F.sum(cut.cast("int")).over(upto)}, {"filled": F.max("row").over(Window.partitionBy(key, "part"))}, {"prev": prev},
        {"section": F.sum(opens.cast("int")).over(upto) - 1, "inside": F.last(F.when(cut, ~F.col("stop")), ignorenulls=True).over(upto)}
    )
    return steps, {"begin": F.min("n").over(section), "first_row": F.min(F.when(F.col("row"), F.col("n"))).over(section)}


def sectioned(lines: DataFrame, key: str) -> DataFrame:
    """The lines of statements, with the number of their section and the place of its first row.

    A title opens a section, unless it repeats the kind of the one before and
    no row stood between; a stop ends it.  Sections without rows are left out.
    """
    steps, places = _section_steps(key)
    for step in steps:
        lines = lines.withColumns(step)
    inside = lines.where("inside and section >= 0").withColumns(places)
    return inside.where("first_row is not null").drop("part", "filled", "prev", "inside")


@once
def _label_steps(key: str) -> tuple:
    col = F.col
    opening = (col("n") == col("first_row") - 1) & ~col("title") & (F.size("tokens") == 0) & ~col("dated") & ~col("line").rlike(r"\d{4}|\bended\b|^\(")
    below = (col("n") > col("first_row")) & (F.size("tokens") == 0) & ~col("dated")
    place = Window.partitionBy(key, "section").orderBy("n")
    above, upto = place.rowsBetween(Window.unboundedPreceding, -1), place.rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy(key, "section", "grp").orderBy("n")
    restarts = col("text").isNotNull() & (~col("text").rlike(r"^\p{Ll}") | (F.row_number().over(group) == 1))
    waiting = F.collect_list("text").over(Window.partitionBy(key, "section", "grp", "isle").orderBy("n").rowsBetween(-MOST_WAITING, -1))
    joins = (col("own") == "") | col("own").rlike(r"^\p{Ll}")
    label = F.when(col("row"), F.when(joins, F.trim(F.array_join(F.concat("waiting", F.array("own")), " "))).otherwise(col("own")))
    calls = F.coalesce(col("label"), F.when(col("n") > col("first_row"), col("text")))
    parent = F.when(calls.rlike(L.PARENT) & ~calls.rlike(L.SUBROW), F.regexp_replace(calls, r"^[ :]+|[ :]+$", ""))
    goes_on = col("row") & (col("own") == "") & (F.size("waiting") == 0) & _yes(F.lag(F.when(col("row"), col("own") == "")).over(place))
    heads = (col("n") < col("first_row")) & (col("n") < col("begin") + L.HEADER_LINES)
    full = F.when(col("label").rlike(L.SUBROW) & col("parent").isNotNull(), F.concat_ws(" ", "parent", "label")).otherwise(col("label"))
    before = (
        {"grp": F.coalesce(F.sum(col("row").cast("int")).over(above), F.lit(0))}, {"isle": F.sum(restarts.cast("int")).over(group.rowsBetween(Window.unboundedPreceding, 0))},
        {"own": L.line_label(col("head")), "waiting": F.when(col("row"), waiting)}, {"label": label}, {"parent": F.last(parent, ignorenulls=True).over(above)}
    )
    pieces = F.sort_array(F.collect_list(F.when(col("row"), F.struct("n", F.transform("tokens", L.token_figure).alias("values")))))
    after = ({"label": full, "goes_on": goes_on}, {"figure_row": F.sum((col("row") & ~col("goes_on")).cast("int")).over(upto)})
    made = [
        F.min("n").alias("n"), F.min_by("label", "n").alias("label"), F.flatten(pieces["values"]).alias("values"), F.min_by("kind", "n").alias("kind"),
        F.sort_array(F.collect_list(F.when(col("heads"), F.struct("n", "line"))))["line"].alias("header")
    ]
    return {"text": F.when(opening | below, F.trim("line")), "heads": heads}, before, after, made


def labelled(lines: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """(key, *keep, section, figure_row, n, label, values, kind, header) of the rows; header lines are row 0.

    Lines without figures wait for the row below them: from the last that
    doesn't go on in lower case, three at most.  A row without a label of its
    own, or one that goes on in lower case, takes them.  ``Basic`` and
    ``Diluted`` take the last label that calls for them.  Figures on lines of
    their own, below each other, are one row.
    """
    text, before, after, made = _label_steps(key)
    out = lines.withColumns(text).where("row or heads or text is not null")
    for step in before:
        out = out.withColumns(step)
    out = out.where("row or heads")
    for step in after:
        out = out.withColumns(step)
    return out.groupBy(key, *keep, "section", "figure_row").agg(*made)


def statement_rows(filings: DataFrame, key: str, lines: str = "lines", form: str = "form_type") -> DataFrame:
    """The rows of all statements of filings of (key, lines, form).

    Returns key, kind, section, row_no, label, values (without numbers of
    notes), value (the current period's, null if that column is missing),
    usd_value (the same in a column in USD beside it), currency and scale as the section's first 24 lines name them.  A null or
    empty array of lines has no rows.  Keys must be unique.  Work is by filing, in sorted
    runs that spill, so a filing may have any number of lines.
    """
    marked = marked_lines(filings.withColumn("quarter", F.col(form).isin("10-Q", "6-K")), key, lines, ["quarter"])
    found = labelled(sectioned(marked, key), key, ["quarter"])
    # A section's rows come together, as its columns depend on all of them; they are within one filing.
    row = F.struct(F.col("n").alias("row_no"), "label", "values", _kept().alias("kept"))
    whole = found.groupBy(key, "quarter", "section").agg(
        F.min_by("kind", "n").alias("kind"), F.flatten(F.collect_list("header")).alias("header"),
        F.sort_array(F.collect_list(F.when(F.col("figure_row") > 0, row))).alias("rows")
    )
    return current_values(whole, key)


@once
def _kept() -> Column:
    return L.without_notes(F.col("values"))


@once
def _value_steps() -> tuple:
    col = F.col
    sizes = F.filter(F.transform("rows", lambda r: F.size(r["kept"])), lambda n: n > 0)
    counted = lambda s: F.transform(F.array_distinct(s), lambda n: F.struct(F.size(F.filter(s, lambda m: m == n)).alias("times"), n.alias("n")))
    full = F.transform("rows", lambda r: F.size(F.filter(r["values"], lambda v: v.isNotNull())))
    inside = lambda at: F.when(at < col("columns"), at)
    other = lambda x: F.when(col(f"{x}.usd") != col(f"{x}.local"), inside(col(f"{x}.usd")))
    size = F.size("kept")
    return (
        {"text": F.array_join("header", " "), "columns": F.coalesce(F.array_max(let(sizes, counted))["n"], F.lit(0))},
        {
            "again": L.repeated_columns(L.period_flags(col("header")), full),
            "both": L.resolved_columns(L.currency_columns(col("header")), L.dated_column(col("header"))),
            "newest": L.newest_column(col("text"), col("columns"), col("quarter"))
        },
        {
            "at": F.coalesce(inside(col("again.local")), inside(col("both.local")), col("newest")),
            "usd_at": F.when(col("again.local").isNotNull(), other("again")).otherwise(other("both")),
            "currency": L.header_currency(col("text")), "scale": L.header_scale(col("text"))
        }
    ), F.when(col("at") < size, F.get("kept", col("at"))).when(size == 1, F.get("kept", F.lit(0)))


def current_values(sections: DataFrame, key: str) -> DataFrame:
    """The rows of sections of (key, section, kind, header, rows, quarter), each with its current value.

    The column is that of repeated sub-columns, else of currencies and days,
    else of the newest date.  A row with one value has that one.
    """
    steps, value = _value_steps()
    for step in steps:
        sections = sections.withColumns(step)
    rows = sections.select(key, "kind", "section", "at", "usd_at", "currency", "scale", F.inline("rows"))
    return rows.select(
        key, "kind", F.col("section").cast("int").alias("section"), "row_no", "label", F.col("kept").alias("values"), value.alias("value"),
        F.get("kept", F.col("usd_at")).alias("usd_value"), "currency", "scale"
    )
