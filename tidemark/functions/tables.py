"""HTML tables as columns: cells in a grid, labels, figures, kind, newest column and the evidence for a unit.

Everything is array functions on one page's or table's own value, so a page is
read where it lies and only its tables, one row each, go on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import digits_only, let, parse_number
from tidemark.functions.text import normal_label, unescaped
from tidemark.operators.sections import merged_parentheses

#: Points of phrases by kind of table, and how many make a kind.
KIND_POINTS = {
    "IS": ((2, r"(?:total )?(?:net )?revenues?(?:\s|$)"), (3, "gross profit"), (1, r"(?:total )?(?:operating )?expenses"), (2, r"(?:income|loss) from operations|operating (?:income|loss|profit)"), (2, r"cost of (?:revenues?|goods|sales|services)"), (3, r"(?:basic|diluted).*?per (?:share|ads|common|ordinary)"), (1, r"net (?:income|loss|earnings|profit)"), (1, r"income\s+tax|provision\s+for\s+income")),
    "BS": ((3, "total assets"), (3, "total liabilities"), (3, r"(?:stockholders|shareholders|owners).*?equity"), (2, r"(?:total )?current assets"), (2, r"(?:total )?current liabilities"), (1, r"accounts?\s+(?:receivable|payable)"), (1, "goodwill|intangible")),
    "CF": ((4, "operating activities"), (4, "investing activities"), (4, "financing activities"), (2, "depreciation"), (3, r"cash.*?(?:beginning|end) of (?:period|year)"), (1, "stock.based compensation"), (1, "share.based compensation")),
}
LEAST_TEXT, LEAST_POINTS, CASH_FLOW_WINS, PENALTY = 150, 4, 8, 5
#: Fixed values of reading rows: a first figure below ``NOTE_BELOW`` numbers a note if a later one is ``NOTE_TIMES`` as large, or all
#: later ones are below ``SMALL_FIGURES`` and not all whole; labels are in the first cells, up to a figure above ``LABEL_MOST``; heads
#: of tables are the first rows.
NOTE_BELOW, NOTE_TIMES, SMALL_FIGURES, LABEL_CELLS, LABEL_MOST, HEAD_ROWS = 50, 100, 100, 6, 50, 6
NO_CELLS = ("", "$", "RMB", "US$", "R$", "%")
#: Fixed values of units: multipliers to millions, rows of a head that names a unit, rows that are searched for a large figure, the
#: least large figure, characters before and after a table.
UNITS = {"ones": 1e-6, "thousands": 1e-3, "millions": 1.0, "billions": 1e3}
UNIT_ROWS, LARGE_ROWS, LARGE_FIGURE, BEFORE, AFTER = 8, 10, 1_000_000, 20_000, 5_000
#: Where a unit was found, best first, and how reliable that is.
TIERS = ("head", "scale", "decimals", "large", "before", "after", "beside", "document")
RELIABILITY = {"head": 3, "scale": 3, "decimals": 3, "large": 2, "before": 1, "after": 1, "beside": 1, "document": 0}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: What a table that isn't the main income statement says of itself.
NON_GAAP, MOST_NON_GAAP = "non-gaap", 2
RECONCILIATION = r"ifrs\s+adjustment|gaap\s+reconciliation|reconcil.*?to.*?gaap|as\s+reported\s+under\s+(?:us\s+)?gaap"
SEGMENT_ROWS = r"revenue\s+from\s+(?:external|intersegment)"
PERIOD_HEAD = r"(?i)\b(?:month|quarter|ended|year|period|20\d{2}|19\d{2}|january|february|march|april|may|june|july|august|september|october|november|december)\b"
MOST_NAMED_HEADS = 2
DEEP_REVENUE = r"\btotal\s+revenue\b|net\s+interest\s+income"

_GAP = r"(?:\s|&nbsp;|&#160;|<[^>]*>)+"
_STATED = rf"(?i)(?=\bin{_GAP}(?:thousands|millions|billions)\b)"


def _text(markup: Column) -> Column:
    """A cell's text: tags go without a trace, white space is squeezed."""
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(markup, "(?s)<[^>]*>", "")), r"(?U)\s+", " "))


def table_markups(html: Column) -> Column:
    """The tables of a page in the order of their beginnings: structs (idx, start, markup).

    A table's markup lacks that of tables inside it, which stand alone.
    ``start`` counts the characters before it.  Ends without beginnings are ignored;
    a table that never ends goes on to the page's end.
    """
    parts = F.split(html, r"(?i)(?=<table\b)|(?<=</table>)")
    state = "struct<n:int,depth:int,at:int,closed:boolean,out:array<struct<n:int,opens:boolean,depth:int,at:int,part:string>>>"

    def step(s: Column, part: Column) -> Column:
        opens = F.coalesce(part.rlike(r"(?i)^<table\b"), F.lit(False))
        depth = F.greatest(F.lit(0), s["depth"] - s["closed"].cast("int")) + opens.cast("int")
        piece = F.struct(s["n"].alias("n"), opens.alias("opens"), depth.alias("depth"), s["at"].alias("at"), part.alias("part"))
        return F.struct(
            (s["n"] + 1).alias("n"), depth.alias("depth"), (s["at"] + F.length(part)).alias("at"),
            F.coalesce(part.rlike(r"(?i)</table>$"), F.lit(False)).alias("closed"), F.concat(s["out"], F.array(piece)).alias("out")
        )

    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(False).alias("closed"), F.array().alias("out")).cast(state)

    def whole(pieces: Column) -> Column:
        opened = F.filter(pieces, lambda p: p["opens"])
        # What follows an inner table belongs to the last one that began at its own depth.
        after = F.filter(pieces, lambda p: ~p["opens"] & (p["depth"] > 0))
        owner = lambda p: F.array_max(F.transform(F.filter(opened, lambda o: (o["n"] < p["n"]) & (o["depth"] == p["depth"])), lambda o: o["n"]))
        owned = F.transform(after, lambda p: F.struct(owner(p).alias("owner"), p["part"].alias("part")))

        def table(o: Column, i: Column) -> Column:
            rest = F.transform(F.filter(owned, lambda p: p["owner"] == o["n"]), lambda p: p["part"])
            return F.struct(i.alias("idx"), o["at"].alias("start"), F.concat(o["part"], F.array_join(rest, "")).alias("markup"))

        return F.transform(opened, table)

    return let(F.aggregate(parts, zero, step, lambda s: s["out"]), whole)


def grid(markup: Column) -> Column:
    """A table's rows of cells; a cell that spans columns is followed by empty ones."""

    def cells(row: Column) -> Column:
        made = F.transform(
            F.slice(F.split(row, r"(?i)<t[dh]\b"), 2, 100_000),
            lambda cell: F.concat(
                F.array(_text(F.regexp_replace(F.regexp_replace(cell, r"(?is)</t[dhr]\s*>.*$", ""), r"(?s)^[^>]*>?", ""))),
                F.array_repeat(F.lit(""), F.coalesce(F.regexp_extract(cell, r"""(?i)^[^>]*?\bcolspan\s*=\s*["']?\s*(\d{1,2})\b""", 1).try_cast("int"), F.lit(1)) - 1)
            )
        )
        return F.flatten(made)

    return F.transform(F.slice(F.split(markup, r"(?i)<tr\b[^>]*>"), 2, 1_000_000), cells)


def _bare(cells: Column) -> Column:
    """Cells without notes at their ends, and without empty ones."""
    plain = F.transform(cells, lambda c: F.trim(F.regexp_replace(c, r"(?i)\s*\(notes?\s+[\w,\s]+\)\s*$", "")))
    return F.filter(plain, lambda c: ~c.isin(*NO_CELLS))


def _figure(cell: Column) -> Column:
    return digits_only(F.replace(cell, F.lit("−"), F.lit("-")))


def row_figures(cells: Column) -> Column:
    """The values of a row's cells, a leading note's number left out; a parenthesis in a cell of its own closes the one before."""
    closed = F.transform(merged_parentheses(F.transform(_bare(cells), lambda c: F.when(c == ")%", ")").otherwise(c))), _figure)

    def without_note(v: Column) -> Column:
        first, rest = F.get(v, 0), F.slice(v, 2, 100_000)
        far = F.array_max(F.transform(rest, F.abs)) > F.abs(first) * NOTE_TIMES
        fine = (first == F.rint(first)) & F.forall(rest, lambda x: F.abs(x) < SMALL_FIGURES) & F.exists(rest, lambda x: x != F.rint(x))
        return F.when((F.size(v) > 1) & (first != 0) & (F.abs(first) < NOTE_BELOW) & (far | fine), rest).otherwise(v)

    return let(F.filter(closed, lambda x: x.isNotNull()), without_note)


def row_label(cells: Column) -> Column:
    """What a row's first cells say, up to the first figure that can't be a note's number."""

    def label(some: Column) -> Column:
        large = F.transform(some, lambda c: F.coalesce(F.abs(_figure(c)) > LABEL_MOST, F.lit(False)))
        upto = F.array_position(large, F.lit(True)).cast("int")
        kept = F.when(upto > 0, F.slice(some, 1, F.greatest(upto - 1, F.lit(0)))).otherwise(some)
        return F.regexp_replace(F.array_join(kept, " "), r"\s+\d{1,2}$", "")

    return let(_bare(F.slice(cells, 1, LABEL_CELLS)), label)


def labelled_rows(rows: Column) -> Column:
    """A grid's rows as structs (row_no, label, values)."""
    return F.transform(rows, lambda r, i: F.struct(i.alias("row_no"), row_label(r).alias("label"), row_figures(r).alias("values")))


def grid_text(rows: Column) -> Column:
    return F.array_join(F.transform(rows, lambda r: F.array_join(F.filter(r, lambda c: c != ""), " ")), " ")


def table_kind(text: Column) -> Column:
    """IS, BS, CF or null by the points of a table's text; a clear cash-flow table takes points from the income statement."""

    def of(low: Column) -> Column:
        points = {kind: sum((low.rlike(p).cast("int") * n for n, p in rules), F.lit(0)) for kind, rules in KIND_POINTS.items()}
        income = F.when(points["CF"] >= CASH_FLOW_WINS, F.greatest(F.lit(0), points["IS"] - PENALTY)).otherwise(points["IS"])

        def best(p: Column) -> Column:
            both = (p["IS"] >= LEAST_POINTS) & (p["BS"] >= LEAST_POINTS)
            mixed = F.when(low.rlike("per (?:share|ads|ordinary)") | (p["BS"] <= p["IS"]), "IS").otherwise("BS")
            top = F.greatest(p["IS"], p["BS"], p["CF"])
            one = F.when(p["IS"] == top, "IS").when(p["BS"] == top, "BS").otherwise("CF")
            return F.when((F.length(low) >= LEAST_TEXT) & (top >= LEAST_POINTS), F.when(both, mixed).otherwise(one))

        return let(F.struct(income.alias("IS"), points["BS"].alias("BS"), points["CF"].alias("CF")), best)

    return let(F.lower(text), of)


def _month(cell: Column) -> Column:
    """The number of the first month, in the year's order, that a cell names; else 0."""
    low = F.lower(cell)
    return F.coalesce(*(F.when(low.contains(m), k) for k, m in enumerate(MONTHS, 1)), F.lit(0))


def latest_column(rows: Column) -> Column:
    """The place of the newest date among a table's figures, 0 if there is one date or none.

    Dates are years of a head row's cell with the month of that cell, or of the
    first head row that names one in the same column.  A date's place is the
    number of figures above 50 before it in its row.
    """

    def of(head: Column) -> Column:
        place = lambda r, k: F.size(F.filter(F.slice(r, 1, k), lambda c: F.abs(_figure(c)) > LABEL_MOST))
        above = lambda k: F.coalesce(F.get(F.filter(F.transform(head, lambda r: F.coalesce(_month(F.get(r, k)), F.lit(0))), lambda m: m > 0), 0), F.lit(0))

        def dated(r: Column) -> Column:
            def of_cell(c: Column, k: Column) -> Column:
                years = F.regexp_extract_all(c, F.lit("(20[12][0-9])"), 1)
                month = let(_month(c), lambda m: F.when(m > 0, m).otherwise(above(k)))
                key = lambda y: F.struct((y.cast("int") * 100 + month).alias("key"), place(r, k).alias("place"))
                return F.when(F.size(years) > 0, F.transform(years, key)).otherwise(F.array().cast("array<struct<key:int,place:int>>"))

            return F.flatten(F.transform(r, of_cell))

        def newest(dates: Column) -> Column:
            keys = F.transform(dates, lambda d: d["key"])
            top = F.array_max(keys)
            first = F.get(F.filter(dates, lambda d: d["key"] == top), 0)["place"]
            return F.when((F.size(dates) > 0) & (top > F.array_min(keys)), first).otherwise(F.lit(0))

        return let(F.flatten(F.transform(head, dated)), newest)

    return let(F.slice(rows, 1, HEAD_ROWS), of)


def stated_units(html: Column) -> Column:
    """Where a page says ``in thousands`` and the like: structs (at, unit) in order, ``at`` in characters."""
    parts = F.split(html, _STATED)
    state = "struct<at:int,out:array<struct<at:int,unit:string>>>"
    unit = lambda p: F.lower(F.regexp_extract(p, rf"(?i)^in{_GAP}(thousands|millions|billions)\b", 1))
    zero = F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(state)

    def step(s: Column, p: Column) -> Column:
        here = F.array(F.struct(s["at"].alias("at"), unit(p).alias("unit")))
        return F.struct((s["at"] + F.length(p)).alias("at"), F.concat(s["out"], F.filter(here, lambda h: h["unit"] != "")).alias("out"))

    return F.aggregate(parts, zero, step, lambda s: s["out"])


def _mode(values: Column, known: dict[str, str]) -> Column:
    """The unit of the most frequent value, the first of equally frequent ones; null if that is no known one."""
    by = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))

    def of(v: Column) -> Column:
        counts = F.transform(F.array_distinct(v), lambda x: F.struct(F.size(F.filter(v, lambda y: y == x)).alias("n"), (-F.array_position(v, x)).alias("first"), x.alias("x")))
        return F.try_element_at(by, F.array_max(counts)["x"])

    return let(F.filter(values, lambda x: x.rlike(r"^[+-]?\d+$")), of)


def _attribute(markup: Column, name: str) -> Column:
    return F.regexp_extract_all(markup, F.lit(rf"""(?i)<[^>]*\b{name}\s*=\s*["']\s*\+?([^"'\s]+)\s*["']"""), 1)


def head_unit(head: Column) -> Column:
    """The unit that a table's head names in words."""
    worded = F.coalesce(*(F.when(head.rlike(rf"(?i)\bin\s+{'' if unit == 'thousands' else r'(?:\w+\s+)?'}{unit[:-1]}s?\b"), unit) for unit in ("thousands", "millions", "billions")))
    ones = F.when(head.rlike(r"(?i)\bin\s+(?:usd|u\.s\.\s+dollars?|us\s+dollars?)\b"), "ones")
    signs = F.when(head.rlike(r"(?:\$|USD|RMB|CNY|SGD)\s*['’‘`]?\s*000\b"), "thousands")
    return F.coalesce(worded, ones, signs)


def unit_evidence(rows: Column, markup: Column, start: Column, stated: Column) -> Column:
    """Everything that tells a table's unit: structs (tier, distance, unit), best first.

    ``head``: words in its first rows; ``scale`` and ``decimals``: the most frequent of its
    tags' attributes; ``large``: a currency sign alone in a cell and a figure from a million on;
    ``before``, ``after``: the page's nearest words within some thousand
    characters; ``beside``: words right before it, billions too; ``document``: the
    page's last words anywhere.
    """
    head = lambda n: F.array_join(F.flatten(F.slice(rows, 1, n)), " ")
    signs = F.exists(F.flatten(F.slice(rows, 1, HEAD_ROWS)), lambda c: F.exists(F.split(F.upper(c), " "), lambda t: t.isin("US$", "$", "HK$", "C$")))
    figures = F.transform(F.regexp_extract_all(head(LARGE_ROWS), F.lit(r"\b(\d[\d,]+)\b"), 1), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double"))
    large = signs & ~head(HEAD_ROWS).rlike("(?i)thousands|millions|billions") & F.exists(figures, lambda x: x >= LARGE_FIGURE)
    common = lambda s: s["unit"] != "billions"
    nearest = lambda some: F.get(some, F.size(some) - 1)
    ends = start + F.length(markup)
    before = nearest(F.filter(stated, lambda s: common(s) & (s["at"] < start) & (s["at"] >= start - BEFORE)))
    follows = F.filter(stated, lambda s: common(s) & (s["at"] >= start) & (s["at"] < start + AFTER))
    # Of the two units that follow, the one whose last mention comes first.
    last = lambda unit: F.array_max(F.transform(F.filter(follows, lambda s: s["unit"] == unit), lambda s: s["at"]))
    after = F.array_min(F.filter(F.array(*(F.struct(last(u).alias("at"), F.lit(u).alias("unit")) for u in ("thousands", "millions"))), lambda s: s["at"].isNotNull()))
    beside = nearest(F.filter(stated, lambda s: (s["at"] < start) & (s["at"] >= start - 500)))
    document = nearest(F.filter(stated, common))
    zero = F.lit(0)
    found = {
        "head": (zero, head_unit(head(UNIT_ROWS))),
        "scale": (zero, _mode(_attribute(markup, "scale"), {"0": "ones", "3": "thousands", "6": "millions", "9": "billions"})),
        "decimals": (zero, _mode(_attribute(markup, "decimals"), {"0": "ones", "-3": "thousands", "-6": "millions", "-9": "billions"})),
        "large": (zero, F.when(large, "ones")), "before": (start - before["at"], before["unit"]), "after": (after["at"] - start, after["unit"]),
        "beside": (start - beside["at"], beside["unit"]), "document": (F.abs(document["at"] - ends), document["unit"])
    }
    every = [F.struct(F.lit(TIERS.index(t)).alias("tier"), d.cast("int").alias("distance"), u.alias("unit")) for t, (d, u) in found.items()]
    return F.filter(F.array(*every), lambda e: e["unit"].isNotNull())


def _by_tier(tier: Column, values: Callable[[str], object]) -> Column:
    return F.when(tier.isNotNull(), F.element_at(F.lit([values(t) for t in TIERS]), tier + 1))


def tier_name(tier: Column) -> Column:
    return _by_tier(tier, str)


def reliability(tier: Column) -> Column:
    """3 for what a table says of itself, 2 for figures' size, 1 for words near it, 0 for words anywhere or none."""
    return F.coalesce(_by_tier(tier, RELIABILITY.__getitem__), F.lit(0))


def exclusion(rows: Column) -> Column:
    """How unlike the main income statement a table is: 3 not GAAP, 2 a reconciliation, 1 by segments, else 0."""
    low = lambda n: F.lower(F.array_join(F.flatten(F.slice(rows, 1, n)), " "))
    named = lambda r: F.size(F.filter(F.slice(r, 2, 100_000), lambda c: c.rlike("[A-Za-z]") & ~c.rlike(PERIOD_HEAD))) > MOST_NAMED_HEADS
    segments = low(UNIT_ROWS).rlike(SEGMENT_ROWS) | F.exists(F.slice(rows, 1, HEAD_ROWS), named)
    foreign = F.regexp_count(low(1_000_000), F.lit(NON_GAAP)) > MOST_NON_GAAP
    return F.when(foreign, 3).when(low(10).rlike(RECONCILIATION), 2).when(segments, 1).otherwise(0)


def names_revenue(rows: Column, labels: Column) -> Column:
    """Whether revenue stands in a table's first rows, or total revenue or net interest income somewhat further down."""
    low = lambda n: F.lower(F.array_join(F.flatten(F.slice(rows, 1, n)), " "))
    sales = F.exists(F.slice(labels, 1, UNIT_ROWS), lambda x: F.lower(x).rlike(r"^(?:(?:total |net )*sales\b|revenue)"))
    return low(UNIT_ROWS).rlike(r"\brevenues?\b") | sales | low(30).rlike(DEEP_REVENUE)


# --- rows by their labels ----------------------------------------------------------------------------------

#: Figures of a row's text.
_ROW_FIGURE = r"\(\s*[0-9][0-9,]*(?:\.\d+)?\s*\)|[0-9][0-9,]*(?:\.\d+)?"


def html_rows(raw: Column) -> Column:
    """The text of each closed row of a page, tags as spaces."""
    rows = F.regexp_extract_all(raw, F.lit(r"(?is)<tr[^>]*>.*?</tr>"), 0)
    return F.transform(rows, lambda r: F.trim(F.regexp_replace(unescaped(F.regexp_replace(r, "(?s)<[^>]+>", " ")), r"(?U)\s+", " ")))


def row_values(text: Column) -> Column:
    """The figures of a row's text, negative in parentheses."""
    found = F.regexp_extract_all(text, F.lit(f"({_ROW_FIGURE})"), 1)
    return F.filter(F.transform(found, lambda x: parse_number(F.regexp_replace(x, r"\s", ""))), lambda v: v.isNotNull())


def values_like(raw: Column, pattern: str) -> Column:
    """The values of the row that matches and has most of them, the first on ties; null without a match."""
    rows = F.filter(html_rows(raw), lambda r: r.rlike(f"(?i){pattern}"))
    ranked = F.transform(rows, lambda r, i: let(row_values(r), lambda v: F.struct((-F.size(v)).alias("n"), i.alias("i"), v.alias("values"))))
    return F.array_min(ranked)["values"]


def values_of_label(raw: Column, labels: Sequence[str], expected: int | None = None) -> Column:
    """The values of a row whose label is one of ``labels`` or goes on after it; null without such a row with values.

    Of several rows the one whose number of values is nearest to ``expected``
    counts, then the one with fewer, then the first; without ``expected`` the
    one with most.
    """
    def candidate(r: Column, i: Column) -> Column:
        label = F.regexp_replace(normal_label(F.split(r, _ROW_FIGURE, 2)[0]), r"^[ $:-]+|[ $:-]+$", "")
        fits = F.lit(False)
        for target in (normal_label(F.lit(x)) for x in labels):
            fits = fits | (label == target) | label.startswith(F.concat(target, F.lit(" ")))

        def ranked(v: Column) -> Column:
            gap = F.abs(F.size(v) - expected) if expected is not None else -F.size(v)
            return F.when(fits & (F.size(v) > 0), F.struct(gap.alias("gap"), F.size(v).alias("n"), i.alias("i"), v.alias("values")))

        return let(row_values(r), ranked)

    return F.array_min(F.filter(F.transform(html_rows(raw), candidate), lambda x: x.isNotNull()))["values"]
