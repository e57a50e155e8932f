"""Queries on the table and statement plans, on pages and on texts made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.filing_queries import cat, words
from tidemark.functions import document_unit
from tidemark.functions import lines as L
from tidemark.functions import tables as T
from tidemark.operators import lookup
from tidemark.plans import filing_report, page_tables
from tidemark.plans.statement_lines import statement_rows
from tidemark.queries import query
from tidemark.session import shared_folder
from tidemark.sources.prices import read_prices, store_responses
from tidemark.streaming.incremental import waves
from tidemark.streaming.keyed_table import KeyedTable, run_into

c, lit = F.col, F.lit


def row(*cells: object) -> Column:
    return cat("<tr>", *(cat("<td>", x, "</td>") for x in cells), "</tr>")


@query("""with l as (select page_id, html, regexp_extract_all(html, '(?is)<ul>(.*?)</ul>', 1) as ul from pages),
t as (select page_id, unnest(ul) as ul, generate_subscripts(ul, 1) - 1 as idx from l),
r as (select page_id, idx, regexp_extract_all(ul, '(?is)<li>(.*?)</li>', 1) as li from t),
x as (select page_id, idx, unnest(li) as cell, generate_subscripts(li, 1) - 1 as row_no, len(li) as n_rows from r)
select page_id, cast(idx as int) as idx, cast(row_no as int) as row_no, cast(n_rows as int) as n_rows,
       trim(regexp_replace(replace(replace(replace(regexp_replace(cell, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) as cell from x""")
def arr05_grid(t):
    """The lists of all pages, read as tables of one column."""
    html = c("html")
    for old, new in (("<ul>", "<table>"), ("</ul>", "</table>"), ("<li>", "<tr><td>"), ("</li>", "</td></tr>")):
        html = F.replace(html, lit(old), lit(new))
    found = page_tables.page_tables(t.pages.select("page_id", html.alias("html")), "html", ["page_id"])
    cells = found.select("page_id", "idx", F.size("grid").alias("n_rows"), F.posexplode("grid").alias("row_no", "cells"))
    return cells.select("page_id", "idx", "row_no", "n_rows", F.get("cells", lit(0)).alias("cell"))


@query("""select o_orderkey, 'Item ' || o_orderstatus as label, case o_orderkey % 4 when 0 then [2000.0 + o_orderkey, -2.5] when 1 then [-2.17, 3.5] when 2 then [7.0, 8.0] else [-1.0 * (o_custkey + 1)] end::double[] as figures from orders""")
def arr06_row_figures(t):
    """Labels and figures of cells: numbers of notes, parentheses in cells of their own, currency signs."""
    k, label = c("o_orderkey") % 4, cat("Item ", c("o_orderstatus"))
    noted = F.array(label, lit("12"), lit("$"), words(c("o_orderkey") + 2000), lit("(2.5"), lit(")"))
    eps = F.array(cat(label, " (note 7)"), lit(""), lit("3"), lit("(2.17"), lit(")"), lit("US$"), lit("3.5"))
    small = F.array(lit(""), label, lit("7"), lit("8"), lit("%"), lit("n/a"))
    one = F.array(label, lit("RMB"), cat("(", F.format_number(c("o_custkey") + 1, 0), ")"))
    cells = F.when(k == 0, noted).when(k == 1, eps).when(k == 2, small).otherwise(one)
    label = F.when(k == 2, F.regexp_replace(T.row_label(cells), " 7 8.*$", "")).otherwise(F.regexp_replace(T.row_label(cells), r" (?:12|3 \(2|-?\(?2\.17|\().*$", ""))
    return t.orders.select("o_orderkey", label.alias("label"), T.row_figures(cells).alias("figures"))


@query("""select o_orderkey, cast(case when o_orderkey % 4 = 3 then 0 when (y0, m0) >= (y1, m1) then case when (y2, m2) > (y0, m0) then 2 else 0 end else case when (y2, m2) > (y1, m1) then 2 else 1 end end as int) as place
from (select o_orderkey, extract(year from o_orderdate) + 20 as y0, extract(month from o_orderdate) as m0, extract(year from o_orderdate) + 20 + o_custkey % 2 as y1, (o_custkey % 12) + 1 as m1,
             extract(year from o_orderdate) + 21 - o_custkey % 3 % 2 as y2, (o_orderkey % 12) + 1 as m2 from orders)""")
def win13_latest_column(t):
    """The place of the newest date: months stand in a head row above or below the years of their column; one date is none."""
    names = F.array(*(lit(m) for m in ("January", "Feb", "March", "APRIL", "may", "Jun", "July", "August", "Sept", "Oct", "November", "Dec")))
    year, month = F.year("o_orderdate") + 20, F.month("o_orderdate")
    years = [year, year + c("o_custkey") % 2, year + 1 - c("o_custkey") % 3 % 2]
    months = [month, (c("o_custkey") % 12 + 1).cast("int"), (c("o_orderkey") % 12 + 1).cast("int")]
    k = c("o_orderkey") % 4
    above = F.array(lit(""), *(F.element_at(names, m) for m in months))
    below = F.array(lit(""), *(words(y) for y in years))
    joined = F.array(lit("USD"), *(cat(F.element_at(names, m), " 5, ", words(y)) for m, y in zip(months, years, strict=True)))
    only = F.array(F.array(lit(""), words(year)), F.array(lit("x"), lit("900")))
    rows = F.when(k == 0, F.array(above, below)).when(k == 1, F.array(below, above)).when(k == 2, F.array(joined, F.array(lit("x"), lit("100")))).otherwise(only)
    return t.orders.select("o_orderkey", T.latest_column(rows).alias("place"))


UNIT_CASES = """case s_suppkey % 10 when 0 then 'head' when 1 then 'head' when 2 then 'scale' when 3 then 'decimals' when 4 then 'large' when 5 then 'before' when 6 then 'after' when 7 then 'beside' when 8 then 'document' end as tier,
case s_suppkey % 10 when 0 then 'millions' when 1 then 'thousands' when 2 then 'millions' when 3 then 'thousands' when 4 then 'ones' when 5 then 'thousands' when 6 then 'millions' when 7 then 'billions' when 8 then 'thousands' end as unit,
cast(case s_suppkey % 10 when 0 then 3 when 1 then 3 when 2 then 3 when 3 then 3 when 4 then 2 when 5 then 1 when 6 then 1 when 7 then 1 else 0 end as int) as reliability"""


@query(f"select s_suppkey, {UNIT_CASES} from supplier")
def str16_unit_evidence(t):
    """Where a table's unit is told, in eight places of falling rank; worse places say otherwise and lose."""
    k = c("s_suppkey") % 10
    tags = lambda *some: cat("<tr><td>", *(f"<ix:nonFraction {x}>1</ix:nonFraction>" for x in some), "</td></tr>")
    scales, decimals = tags('scale="6"', "scale='6'", 'scale="3"', 'decimals="-3"'), tags('decimals="-3"', 'decimals="INF"')
    body = row("Total", words(c("s_suppkey") + 5))
    large = cat(row("", "US$"), row("Total", "1,234,567"))
    filler = lit(" " + "x" * 21_000)
    made = (
        F.when(k == 0, cat("in thousands <table>", row("(in US millions, except", " per share)"), scales, "</table>"))
        .when(k == 1, cat("in millions <table>", row("RMB’000"), tags('scale="9"'), "</table>"))
        .when(k == 2, cat("in billions in thousands <table>", scales, large, "</table>"))
        .when(k == 3, cat("in millions <table>", decimals, large, "</table>"))
        .when(k == 4, cat("in millions <table>", large, "</table> in thousands"))
        .when(k == 5, cat("in millions <p>in <b>thousands</b></p> <table>", body, "</table> in millions"))
        .when(k == 6, cat("in thousands", filler, "<table>", body, "</table> in millions and in thousands"))
        .when(k == 7, cat("in thousands", filler, "<p>(in billions)</p><table>", body, "</table>"))
        .when(k == 8, cat("in millions in thousands", filler, "<table>", body, "</table>"))
        .otherwise(cat("<table>", body, "</table>"))
    )
    found = page_tables.page_tables(t.supplier.select("s_suppkey", made.alias("html")), "html", ["s_suppkey"])
    best = F.array_min(T.unit_evidence(c("grid"), c("markup"), c("start"), c("stated")))
    x = found.withColumn("best", best)
    return x.select(
        "s_suppkey", T.tier_name(c("best.tier")).alias("tier"), c("best.unit").alias("unit"), T.reliability(c("best.tier")).alias("reliability")
    )


@query("""select s_suppkey, cast(case s_suppkey % 4 when 0 then 1 when 1 then 2 when 2 then 1 else 0 end as int) as idx, case s_suppkey % 4 when 0 then 100.0 + s_suppkey when 1 then 300.0 when 2 then 100.0 + s_suppkey else 200.0 end as revenue from supplier""")
def flt18_income_choice(t):
    """The income statement among longer tables: by segments, reconciliations, not GAAP; the least odd one where all are."""
    k = c("s_suppkey") % 4
    base = [("Gross profit", "50"), ("Cost of revenues", "40"), ("Operating income", "30"), ("Income tax expense of the whole group of companies", "5"), ("Net income", "20")]
    more = cat(*(row(f"Other item {n} of the segments", "5", "6") for n in range(6)))
    table = lambda head, revenue, extra: cat("<table>", head, row("Total revenues", revenue), *(row(*x) for x in base), extra, "</table>")
    years = row("", "Year ended December 31, 2024", "Year ended December 31, 2023")
    main = table(years, words(c("s_suppkey") + 100), "")
    segment = table(row("", "Asia", "Europe", "Americas", "2024"), "200", more)
    bridge = table(row("Reconciliation of results to GAAP", "2024"), "300", more)
    other = table(row("Non-GAAP results", "non-GAAP", "2024"), "400", cat(row("Non-GAAP net income", "5"), more))
    html = F.when(k == 0, cat(segment, main, bridge)).when(k == 1, cat(other, other, bridge)).when(k == 2, cat(other, main, segment)).otherwise(cat(segment, bridge, other))
    best = filing_report.best_tables(t.supplier.select(c("s_suppkey").alias("filing_id"), html.alias("raw"))).where("kind = 'IS'")
    first = F.filter("rows", lambda r: r["label"] == "Total revenues")[0]["values"]
    return best.select(c("filing_id").alias("s_suppkey"), "idx", F.get(first, lit(0)).alias("revenue"))


@query("""select o_orderkey, cast(case o_orderkey % 7 when 0 then 3 when 1 then 2 when 2 then 2 when 3 then 1 when 4 then 3 end as int) as dated,
cast(case o_orderkey % 7 when 3 then 0 when 6 then 1 end as int) as local_column, cast(case o_orderkey % 7 when 3 then 1 when 6 then 2 end as int) as usd_column,
cast(case o_orderkey % 7 when 3 then 5 end as int) as repeated, case o_orderkey % 7 when 0 then 15.0 when 1 then 1200.0 when 2 then 14.0 when 3 then 14.0 end::double as mixed from orders""")
def win20_columns(t):
    """Which column is current, by each rule: days in order, years beside quarters, repeated days, currencies, sub-columns, counts; days such as 5-Jun-2025 aren't read."""
    k = c("o_orderkey") % 7
    arr = lambda *x: F.array(*(lit(y) for y in x))
    header = (
        F.when(k == 0, arr("Three months ended and nine months ended", "June 30, 2023, June 30, 2024", "March 31, 2025, June 30, 2025"))
        .when(k == 1, arr("For the quarter ended", "For the year ended", "2023 2024", "2024 2023"))
        .when(k == 2, arr("As of", "March 31, 2023 June 30, 2023 June 30, 2024", "March 31, 2022 May 1, 2022"))
        .when(k == 3, arr("Dec 31, 2023 RMB", "December 31, 2024", "(unaudited) RMB", "March 1, 2024 US$", "April 1, 2020 RMB"))
        .when(k == 4, arr("June 30, 2025 June 30, 2024", "June 30, 2023 June 30, 2025"))
        .when(k == 5, arr("5-Jun-2024", "5-Jun-2025 4-May-24 5-Jun-2025"))
        .otherwise(arr("RMB", "(audited)", "RMB", "US$", "no more", "RMB"))
    )
    sizes = F.when(k == 3, arr(4, 8, 8, 3, 12)).otherwise(arr(4, 4))
    values = F.when(k == 0, arr(10.0, 11.0, 12.0, 13.0, 14.0, 15.0, 16.0)).when(k == 1, arr(5.0, 1000.0, 1100.0, 1200.0, 1300.0, 1400.0, 1500.0, 1600.0))
    values = values.when(k == 2, arr(110.0, 11.0, 12.0, 13.0, 14.0, 15.0, 9.0)).when(k == 3, arr(110.0, 11.0, 14.0, 13.0)).otherwise(arr(1.0, 2.0))
    by_currency = L.currency_columns(header)
    x = t.orders.select("o_orderkey", L.dated_column(header).alias("dated"), by_currency.alias("m"), L.repeated_columns(L.period_flags(header), sizes).alias("r"), L.mixed_value(values, k == 0, lit(False)).alias("mixed"))
    return x.select("o_orderkey", "dated", c("m.local").alias("local_column"), c("m.usd").alias("usd_column"), c("r.usd").alias("repeated"), "mixed")


@query("""select s_suppkey, kind, cast(n as int) as n, value from (select s_suppkey, 'income' as kind, 3 as n, 40.0 + s_suppkey as value from supplier union all select s_suppkey, 'balance', 2, 80.0 + s_suppkey from supplier union all
select s_suppkey, 'cash', 1, -9.0 from supplier where s_suppkey % 2 = 0)""")
def win09_statement_sections(t):
    """Statements between titles and stops: repeated titles, titles within prose, labels over lines, figures below each other."""
    k = words(c("s_suppkey") + 40)
    lines = F.array(
        *(x if isinstance(x, Column) else lit(x) for x in [
            "Total revenues 1 2", "See the statements of income for 2024", "CONSOLIDATED STATEMENTS OF INCOME", "(continued)", "Consolidated Statements of Income", "2024 2023",
            cat("Revenues ", k, " 7"), "Expenses of all the", "many companies,", "and others (5) (6)", "Net income", k, "8",
            "Notes to consolidated financial statements", "Revenues 1 1", "BALANCE SHEETS", "2024 2023", cat("Total assets ", words(c("s_suppkey") + 80), " 3"), "Equity — 4",
            F.when(c("s_suppkey") % 2 == 0, "Statements of cash flows").otherwise("Signatures"), "2024 2023", "Capital expenditures (9) (8)"
        ])
    )
    rows = statement_rows(t.supplier.select("s_suppkey", lines.alias("lines"), lit("10-K").alias("form_type")), "s_suppkey")
    rows = rows.where("s_suppkey % 2 = 0 or kind <> 'balance' or label not like 'Capital%'")
    return rows.groupBy("s_suppkey", "kind").agg(F.count("*").cast("int").alias("n"), F.min_by("value", "row_no").alias("value"))


@query("""with d as (select distinct unnest([p_type, split_part(p_name, ' ', 2), substr(p_name, 2, 9), substr(p_name, 1, 3)]) as target from part)
select p_partkey, d.target, contains(p_name, d.target) as within, starts_with(p_name, d.target) as begins from part join d on contains(p_name, d.target)""")
def join09_label_index(t):
    """All parts with each entry of a dictionary that grows with them, found by hash joins: within names, and at their beginnings."""
    parts = t.part.select("p_partkey", c("p_name").alias("label"))
    entries = F.array("p_type", F.split("p_name", " ")[1], F.substring("p_name", 2, 9), F.substring("p_name", 1, 3))
    labels = t.part.select(F.explode(entries).alias("target")).distinct()
    within = lookup.matched_labels(parts, labels, "contains").select("p_partkey", "target", lit(True).alias("within"))
    begins = lookup.matched_labels(parts, labels, "prefix").select("p_partkey", "target", lit(True).alias("begins"))
    return within.join(begins, ["p_partkey", "target"], "left").select("p_partkey", "target", "within", F.coalesce("begins", lit(False)).alias("begins"))


@query("""select s_suppkey, case when s_suppkey % 3 = 0 then [1.0, -2.0] else [3000.0] end::double[] as nearest, [1.0 * s_suppkey, 2.0, 3.0, 4.0]::double[] as most, [9.0, 8.0]::double[] as matched from supplier""")
def arr09_html_rows(t):
    """Values of table rows by label: as many as expected, or most; and of the row that matches a pattern."""
    k = words(c("s_suppkey"))
    even = F.when(c("s_suppkey") % 3 == 0, row("Net&nbsp;sales", "1", "(2)")).otherwise(row("Net sales of", "3,000"))
    html = cat("<table>", row("Net sales", k, "2", "3"), even, row("Net sales: total", k, "2", "3", "4"), row("Net salesmen", "5", "5"), row("Gross margin", "9", "8"), row("Margin", "7"), "</table>")
    nearest, most = T.values_of_label(c("html"), ["net sales"], 2), T.values_of_label(c("html"), ["Net sales"])
    return t.supplier.select("s_suppkey", html.alias("html")).select("s_suppkey", nearest.alias("nearest"), most.alias("most"), T.values_like(c("html"), "margin").alias("matched"))


@query("""select s_suppkey, case s_suppkey % 9 when 0 then 'CNY' when 1 then 'USD, millions' when 2 then 'HKD, thousands' when 3 then 'TWD, millions' when 4 then 'EUR, thousands' when 5 then 'JPY, millions' when 6 then 'BRL, thousands' when 7 then 'USD, billions' end as unit,
cast(case s_suppkey % 9 when 0 then 0 when 1 then 1 when 2 then 2 when 3 then 3 when 4 then 4 when 5 then 5 when 6 then 5 when 7 then 5 end as int) as tier from supplier""")
def str12_document_unit(t):
    """A filing's unit from six kinds of places; worse places that say otherwise lose."""
    k = c("s_suppkey") % 9
    arr = lambda *x: F.array(*(lit(y) for y in x))
    worse = ("The yen and the euro fell.", "Total in thousands, amounts in euros")
    lines = (
        F.when(k == 0, arr("Our reporting currency is the Renminbi.", "Consolidated balance sheets", "(in millions of US$)"))
        .when(k == 1, arr(*worse, "Our reporting currency is the US dollar", "Consolidated statements of income", "for the year", "(U.S. dollars", "in millions)"))
        .when(k == 2, arr(*worse, "Income statements", "2024 2023", "HK$ HK$", "(in thousands)", "RMB"))
        .when(k == 3, arr(*worse, "All amounts in millions of", "the issuer's New Taiwan dollars, unless noted", "in EUR thousands"))
        .when(k == 4, arr("The yen fell.", "All figures in", "EUR thousands", "Report"))
        .when(k == 5, arr("Statement of changes", "USD", "JPY", "JPY", "(in millions)", "USD"))
        .when(k == 6, arr("Letter to holders", "Prices in R$'000 each", "and more"))
        .when(k == 7, arr("Letter", "We earned $5"))
        .otherwise(arr("Letter", "Nothing here"))
    )
    raw = F.when(k == 7, "<ix:nonFraction scale='9'>1</ix:nonFraction><ix:nonFraction scale='9'>1</ix:nonFraction><ix:nonFraction scale='3'>1</ix:nonFraction>")
    raw = raw.when(k == 5, "<xbrli:measure>iso4217:EUR</xbrli:measure>").otherwise("")
    x = t.supplier.select("s_suppkey", raw.alias("raw"), lines.alias("lines")).select("s_suppkey", document_unit.unit_evidence("raw", "lines").alias("e"))
    return x.select("s_suppkey", document_unit.document_unit(c("e")).alias("unit"), F.get("e", lit(0))["tier"].alias("tier"))


@query("""select o_custkey, case when o_custkey % 50 = 3 then 'changed' else 'first' end as state, count(*) as n, max(o_orderkey) as newest from orders where o_custkey % 50 <> 4 or o_custkey % 3 = 0 group by 1, 2
union all select -o_nation, 'added', 1, o_nation from (select n_nationkey + 1 as o_nation from nation)""")
def snk09_keyed_table(t):
    """Customers' orders in a keyed table: a first write, changes to a few keys, and keys added."""
    table = KeyedTable(t.spark, shared_folder(t.spark, "keyed"), ["o_custkey"], 8)
    some = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("newest"))
    some = some.where("o_custkey % 50 <> 4 or o_custkey % 3 = 0").select("o_custkey", lit("first").alias("state"), "n", "newest")
    table.upsert(some)
    table.upsert(some.where("o_custkey % 50 = 3").withColumn("state", lit("changed")))
    table.upsert(t.nation.select((-c("n_nationkey") - 1).cast(some.schema["o_custkey"].dataType).alias("o_custkey"), lit("added").alias("state"), lit(1).cast("long").alias("n"), (c("n_nationkey") + 1).cast(some.schema["newest"].dataType).alias("newest")))
    return table.read()


@query("select user_id, event_id, value from (select *, row_number() over (partition by user_id order by event_id desc) r from events) where r = 1")
def stm02_stream_upserts(t):
    """Each user's last event, kept up to date by a stream of files in waves, two to a batch."""
    schema = "event_id long, user_id long, value double"
    folder, table = shared_folder(t.spark, "waves"), KeyedTable(t.spark, shared_folder(t.spark, "users"), ["user_id"], 16)
    t.events.select(c("event_id").cast("long"), c("user_id").cast("long"), "value").repartition(6, "event_id").write.parquet(folder)
    stream = waves(t.spark, folder, schema, 2)

    def newest(batch):
        there = table.read().select("user_id", c("event_id").alias("old")) if table.versions() else batch.limit(0).select("user_id", c("event_id").alias("old"))
        return batch.join(there, "user_id", "left").where("old is null or event_id > old").drop("old")

    run_into(stream, newest, table, "event_id", shared_folder(t.spark, "users-checkpoint")).awaitTermination()
    return table.read().select("user_id", "event_id", "value")


@query("""select 'C' || c_custkey as ticker, case when c_acctbal > 0 and c_custkey % 5 <> 0 then c_acctbal when c_custkey % 7 = 0 then 7.5 end as price, cast(case when c_acctbal > 0 and c_custkey % 5 <> 0 then 0 when c_custkey % 7 = 0 then 1 end as int) as source,
case when (c_acctbal > 0 and c_custkey % 5 <> 0) or c_custkey % 7 = 0 then null when c_custkey % 5 = 0 then 'no data' else 'no price' end as reason from customer where c_custkey % 20 < 9""")
def src18_stored_prices(t):
    """Prices of customers' tickers from two folders of responses, read in waves by a data source."""
    first, second = shared_folder(t.spark, "prices"), shared_folder(t.spark, "more-prices")
    some = t.customer.where("c_custkey % 20 < 9").select(cat("C", words(c("c_custkey"))).alias("ticker"), "c_custkey", c("c_acctbal").cast("double").alias("price"))
    store_responses(some.where("c_custkey % 5 <> 0"), first)
    store_responses(some.where("c_custkey % 7 = 0").withColumn("price", lit(7.5)), second)
    return read_prices(some.select(F.lower("ticker").alias("ticker")), [first, second], wave=25)
