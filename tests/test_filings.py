"""Filings from a folder to reports, the line and table engines, stored market data, writers and pacing."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import prose, statements, tables, text
from tidemark.operators import control, lookup
from tidemark.plans import filing_report, page_tables
from tidemark.plans.statement_lines import statement_rows
from tidemark.queries import QUERIES
from tidemark.sources import files, market, reports
from tidemark.streaming.incremental import merge_partitions

STATEMENT = """ALPHA LTD
CONSOLIDATED STATEMENTS OF OPERATIONS
(in thousands of US dollars, except per share data)
Three months ended December 31, Nine months ended December 31,
2025 2024 2025 2024
Revenues 5 1,000 900 3,000 2,700
Cost of revenues (600) (500) (1,800) (1,500)
Operating expenses:
Research and development (50) (40) (150 ) (120)
Net income attributable to
ordinary shareholders 200 210 600 630
Net income per share:
Basic $ 0.20 $ 0.21 $ 0.60 $ 0.63
CONSOLIDATED BALANCE SHEETS
(RMB in millions)
December 31, 2024 December 31, 2025
Cash and cash equivalents 10 12
Total assets
100
120
Total liabilities — 40
Notes to consolidated financial statements
Total 9 9""".split("\n")


def rows_of(spark, texts, form):
    df = spark.createDataFrame([(i, x, form) for i, x in enumerate(texts)], "id long, lines array<string>, form_type string")
    return statement_rows(df, "id").orderBy("id", "section", "row_no").collect()


def test_statement_lines(spark):
    got = rows_of(spark, [STATEMENT, None, [], ["Revenues 5 6"], ["Notes to financial statements", None, ""]], "10-Q")
    assert {(r.id, r.label): (r.value, r.currency, r.scale) for r in got} == {
        (0, "Revenues"): (1000.0, "USD", 1e3), (0, "Cost of revenues"): (-600.0, "USD", 1e3), (0, "Research and development"): (-50.0, "USD", 1e3),
        (0, "Net income attributable to ordinary shareholders"): (200.0, "USD", 1e3), (0, "Net income per share Basic"): (0.2, "USD", 1e3),
        (0, "Cash and cash equivalents"): (12.0, "CNY", 1e6), (0, "Total assets"): (120.0, "CNY", 1e6), (0, "Total liabilities"): (40.0, "CNY", 1e6),
    }
    assert [r.value for r in rows_of(spark, [STATEMENT], "20-F")][:3] == [3000.0, -1800.0, -150.0]


def test_statement_columns_in_two_currencies(spark):
    text = ["Statements of income", "For the year ended", "2023 2024 2024", "RMB RMB US$", "Revenues 900 1,000 140", "Net income 90 100 14", "Other 5"]
    got = rows_of(spark, [text], "20-F")
    assert [(r.label, r.value, r.usd_value) for r in got] == [("Revenues", 1000.0, 140.0), ("Net income", 100.0, 14.0), ("Other", 5.0, None)]


def test_negative_figures_like_years(spark):
    """A year alone in parentheses is a figure below 0; years in a header stay days."""
    text = [
        "CONSOLIDATED STATEMENTS OF OPERATIONS", "(Year ended December 31, 2025)", "(2025 and 2024)", "2025 2024", "Revenues 3000 4000",
        "Cost of revenues (1) (1901 )", "Expenses (2001) (1999)", "Tax ( 2024)"
    ]
    got = rows_of(spark, [text], "10-K")
    assert [(r.label, r["values"]) for r in got] == [
        ("Revenues", [3000.0, 4000.0]), ("Cost of revenues", [-1901.0]), ("Expenses", [-2001.0, -1999.0]), ("Tax", [-2024.0])
    ]  # the (1) is a note's number


def test_filings_of_very_many_lines(spark):
    """A hundred thousand lines: rows, labels over lines, figures below each other, digits without end."""
    body = []
    for k in range(25_000):
        body += [f"Item number {k} of the", "company", str(k + 1), "7"]
    text = ["BALANCE SHEETS", "2024 2023", *body, "9" * 20_000 + "x"]
    got = rows_of(spark, [text, STATEMENT], "10-K")
    # Before the first row only the line right above it is its label.
    assert [(r.label, r.value) for r in got[:2]] == [("company", 1.0), ("Item number 1 of the company", 2.0)]
    assert len(got) == 25_000 + 8 and all(r["values"][-1] == 7.0 for r in got[:25_000])


def grids_of(spark, pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "id long, html string")
    return page_tables.page_tables(df, "html", ["id"]).orderBy("id", "idx").collect()


def test_table_grids(spark):
    inner = "<table><tr><td colspan=2>a</td><td>b<table><tr><td>x</td></tr></table>c</td></tr><tr><th>1,000</th></tr></table>"
    pages = [inner, None, "", "no", "</table><table><tr><td", "<TABLE><tr><td>&amp; <b>t</b>wo</TD></table>y<table></table>"]
    got = [(r.id, r.idx, r.grid) for r in grids_of(spark, pages)]
    assert got == [(0, 0, [["a", "", "bc"], ["1,000"]]), (0, 1, [["x"]]), (4, 0, [[""]]), (5, 0, [["& two"]]), (5, 1, [])]
    deep = "<table><tr><td>" * 40 + "x" + "</td></tr></table>" * 40
    assert [r.grid for r in grids_of(spark, [deep])][39] == [["x"]] and len(grids_of(spark, [deep])) == 40


def test_rows_of_tables(spark):
    cells = [["Net loss (note 3)", "3", "(2.17", ")", "$", "3.5"], ["x", "3", "1,500", "2,000"], ["no"], ["", "Total", "$", "assets (note 4)", "5", "1,000", "z"], []]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(cells)], "k int, cells array<string>")
    got = df.select("k", tables.row_figures(F.col("cells")).alias("v"), tables.row_label(F.col("cells")).alias("label")).orderBy("k").collect()
    assert [r.v for r in got] == [[-2.17, 3.5], [1500.0, 2000.0], [], [1000.0], []]
    assert got[3].label == "Total assets" and got[4].label == ""
    heads = [[["", "2023", "2024", "2025"]], [["", "Sep", "Jun"], ["", "2024", "2025"]], [["a"]], [], [["2024", "x"], ["2024"]]]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(heads)], "k int, g array<array<string>>")
    assert [r[0] for r in df.orderBy("k").select(tables.latest_column(F.col("g"))).collect()] == [2, 1, 0, 0, 0]


def test_labels_are_looked_up(spark):
    """A dictionary of 100,000 labels, by hash joins."""
    labels = spark.range(100_000).select(F.concat(F.lit("item "), F.col("id")).alias("target"))
    rows = spark.createDataFrame([("an item 77 of all",), ("item 5",), ("x",), ("",), (None,)], "label string")
    within = lookup.matched_labels(rows, labels.unionByName(spark.createDataFrame([("",), (None,)], "target string")), "contains")
    assert sorted((r.label, r.target) for r in within.collect()) == [
        ("", ""), ("an item 77 of all", ""), ("an item 77 of all", "item 7"), ("an item 77 of all", "item 77"), ("item 5", ""), ("item 5", "item 5"), ("x", "")
    ]
    begins = lookup.matched_labels(rows, labels, "prefix")
    assert [(r.label, r.target) for r in begins.collect()] == [("item 5", "item 5")]
    assert "NestedLoop" not in begins._jdf.queryExecution().toString() + within._jdf.queryExecution().toString()


def test_looked_up_rows_are_not_broadcast(spark, sf_dir):
    """Rows by their runs of characters are many times the table, however small Spark takes it to be."""
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.col("p_name").alias("label"))
    labels = spark.range(200_000).select(F.concat(F.lit("item "), F.col("id")).alias("target")).union(rows.select("label"))
    for how in ("contains", "prefix"):
        found = lookup.matched_labels(rows, labels, how)
        assert found.count() > 0
        assert "Broadcast" not in found._jdf.queryExecution().optimizedPlan().toString() + found._jdf.queryExecution().sparkPlan().toString()


def test_small_dictionaries_go_to_the_rows(spark, sf_dir):
    """A few labels are broadcast, whatever Spark takes rows and labels to be; the rows aren't dealt out."""
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.col("p_type").alias("label"))
    labels = spark.createDataFrame([("STEEL", 0), ("A", 5), (None, 6)], "target string, rk int")
    for how in ("contains", "prefix"):
        found = lookup.matched_labels(rows, labels, how)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan
        want = [r.p_partkey for r in rows.collect() for x in ("STEEL", "A") if (r.label.startswith(x) if how == "prefix" else x in r.label)]
        assert sorted(r.p_partkey for r in found.collect()) == sorted(want)


def test_plans_run_no_python(spark, sf_dir):
    for name in ("win08_best_table", "arr08_statement_rows", "plan_reports"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_ratios_in_words():
    said = {
        "two ordinary shares equal one ADS": 2.0, "5 ordinary shares to one ADS": 5.0, "one ADS to 8 ordinary shares": 8.0,
        "We sold 5,000,000 ADSs, each representing two ordinary shares. Each ADS represents three ordinary shares.": 3.0,
        "the ADSs trade. Ordinary shares don't": None, "": None
    }
    assert {t: prose.stated_ratio(t) for t in said} == said
    assert [prose.simple_ratio(x) for x in (0.3334, 7.01, 55.123, None, -1.0)] == [pytest.approx(1 / 3), 7.0, pytest.approx(55.1, abs=0.1), None, None]


def test_reports_from_a_folder(spark, tmp_path):
    folder = tmp_path / "AAA"
    folder.mkdir()
    body = "".join(f"<p>{x}</p>" for x in STATEMENT)
    (folder / "AAA_10-Q_2026-01-30.htm").write_text(f"<html>{body}</html>")
    (folder / ".hidden.htm").write_text("no")
    (folder / "latin.txt").write_bytes("<TYPE>6-K\nCaf\xe9".encode("latin-1"))
    found = files.filings(spark, str(tmp_path), ticker="aaa")
    assert sorted(r.name for r in found.collect()) == ["AAA_10-Q_2026-01-30.htm", "latin.txt"]
    row = filing_report.reports(found).where("form_type = '10-Q'").first()
    assert (row.ticker, row.filing_date, row.period_end_date, row.currency_unit) == ("AAA", "January 30, 2026", "December 31, 2025", "USD")
    assert (row.revenue, row.cogs, row.net_income, row.total_assets, row.equity) == (1e6, 6e5, 2e5, 120e6, 80e6)
    assert files.filings(spark, str(tmp_path), ticker="b").count() == 0


def test_stored_market_data(spark, tmp_path):
    for name, body in {
        "q.json": {
            "quoteResponse": {
                "result": [{"symbol": "aaa", "regularMarketPrice": 5.0}, {"symbol": "BBB", "regularMarketPrice": 0.0}]
            }
        },
        "p.json": {"ticker": "CCC", "results": [{"c": 7.5}]},
        "g.json": {"results": [{"T": "b", "c": 2.0}, {"T": "a", "c": 1.0}, {"T": "a", "c": 3.0}, {"T": "x", "c": 0.0}]}
    }.items():
        (tmp_path / name).write_text(json.dumps(body))
    (tmp_path / "d.csv").write_text("Symbol,Date,Time,Open,High,Low,Close,Volume\nbbb.us,d,t,1,1,1,4.5,9\n")
    wanted = spark.createDataFrame([("aaa",), ("BBB ",), ("ccc",), ("ddd",), ("",)], "ticker string")
    sources = [
        ("quotes", market.batch_quotes(spark, str(tmp_path / "q.json"))),
        ("daily", market.daily_csv(spark, str(tmp_path / "d.csv"))),
        ("previous", market.previous_close(spark, str(tmp_path / "p.json")))
    ]
    got = market.fetched_prices(wanted, sources)
    assert {(r.ticker, r.price, r.source, r.reason) for r in got.collect()} == {
        ("AAA", 5.0, "quotes", None), ("BBB", 4.5, "daily", None), ("CCC", 7.5, "previous", None), ("DDD", None, None, "no data")
    }
    assert [tuple(r) for r in market.failure_reasons(got).collect()] == [("no data", 1)]
    assert [tuple(r) for r in market.grouped_daily(spark, str(tmp_path / "g.json")).collect()] == [("A", 3.0), ("B", 2.0)]
    assert [r["keys"] for r in market.chunked(wanted.where("ticker <> ''"), "ticker", 3).orderBy("chunk").collect()] == [["BBB ", "aaa", "ccc"], ["ddd"]]


def test_writers(spark):
    df = spark.createDataFrame([(1, "B", 2.0), (0, "A", None)], "ord int, ticker string, revenue double")
    assert json.loads(reports.json_array(df, ["ticker", "revenue"]).first().value) == [{"ticker": "A", "revenue": None}, {"ticker": "B", "revenue": 2.0}]
    assert len(reports.with_fields(df).columns) == 55 and reports.with_fields(df).first().cash is None
    assert [reports.report_format(p) for p in ("a.csv", "b.TSV", "c.log")] == ["csv", "tsv", "txt"] and reports.report_format("a.csv", "txt") == "txt"
    screen = spark.createDataFrame([(0, "AAA", 5e7, 1e9, 5.0)], "ord int, ticker string, surplus double, market_cap double, surplus_pct_of_mcap double")
    assert reports.screen_report(screen, "txt").collect()[1].value.split() == ["AAA", "50.00M", "1.00B", "5.00%"]
    box = reports.with_fields(df.where("ord = 1")).select(reports.boxed().alias("b")).first().b.split("\n")
    assert len(box) == 9 and "2.00" in box[3]


def test_null_keys_and_overlays(spark):
    a = spark.createDataFrame([("f", None, 1.0)], "id string, ref string, v double")
    assert lookup.union_missing(a, spark.createDataFrame([("f", None, 1.0), ("f", "c", 1.0), ("f", "c", 1.0)], a.schema), ["id", "ref", "v"]).count() == 2
    with pytest.raises(ValueError, match="patterns"):
        lookup.matched_labels(a.withColumnRenamed("id", "label"), spark.range(3000).select(F.col("id").cast("string").alias("target")), "regex")


def test_partitions_are_merged(spark, tmp_path):
    rows = lambda some: spark.createDataFrame(some, "k int, v string")
    for some in ([(i, "a") for i in range(20)], [(3, "b"), (40, "b")], [(3, "c")]):
        merge_partitions(rows(some), str(tmp_path / "t"), ["k"], 4)
    got = {r.k: r.v for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert got == {i: "a" for i in range(20)} | {3: "c", 40: "b"}


def test_pacing():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(round(s, 6))
        now[0] += s

    pacer = control.Pacer(4.0, lambda: now[0], sleep)
    for _ in range(3):
        pacer.wait()
    assert slept == [0.25, 0.25]
    bucket = control.TokenBucket(2.0, 2.0, lambda: now[0], sleep)
    slept.clear()
    for _ in range(3):
        bucket.take()
    assert slept == [0.5]
    cool = control.Cooldown()
    assert [cool.refused(), round(cool.refused(), 6), cool.refused(100.0)] == [3.0, 5.4, 60.0] and cool.answered() == 51.0
    assert control.retry_after("7") == 7.0 and control.retry_after("soon") is None and control.retry_after("Thu, 01 Jan 1970 00:01:40 GMT", now=40.0) == 60.0
    tries = iter([OSError(), control.Refused(9.0), "done"])

    def call():
        x = next(tries)
        if isinstance(x, Exception):
            raise x
        return x

    slept.clear()
    assert control.with_retries(call, jitter=0.0, sleep=sleep) == "done" and slept == [5.0, 10.0]
    safe = control.guarded(lambda x: 1 / x)
    assert safe(2) == (0.5, None) and safe(0)[1].startswith("ZeroDivisionError")
    import time

    assert control.guarded(lambda x: time.sleep(x), 0.05)(1.0) == (None, "timed out")
    assert control.screen_arguments(["in.json", "--prices", "p.csv", "--output", "o.tsv"]).stale_days == 730


def test_text_helpers(spark):
    df = spark.createDataFrame([("HK$5 (3) —", "Revenue &amp; cost &eacute; (Note 7)")], "a string, b string")
    row = df.select(statements.number_line(F.col("a")).alias("n"), statements.without_note_references(text.every_entity(F.col("b"))).alias("l")).first()
    assert row.n == [5.0, -3.0, None] and row.l == "Revenue & cost é"


def test_transfers_resume(tmp_path):
    from tidemark.sources import fetch

    asked, whole = [], b"0123456789"

    def broken(headers):
        asked.append(dict(headers))

        def body():
            yield whole[:4]
            raise OSError("lost")

        return 200, body()

    with pytest.raises(OSError, match="lost"):
        fetch.resumed(broken, tmp_path / "d" / "f")
    assert fetch.resumed(lambda h: asked.append(dict(h)) or (206, [whole[4:]]), tmp_path / "d" / "f") == "ok"
    assert asked == [{}, {"Range": "bytes=4-"}] and (tmp_path / "d" / "f").read_bytes() == whole
    assert fetch.resumed(broken, tmp_path / "d" / "f") == "exists" and not list(tmp_path.glob("d/*.part"))
    with pytest.raises(OSError, match="404"):
        fetch.resumed(lambda h: (404, []), tmp_path / "g")
    fetch.write_atomically(tmp_path / "p.json", {"b": 1, "a": {"status": "ok"}})
    assert json.loads((tmp_path / "p.json").read_text())["a"]["status"] == "ok"


def test_command_lines(spark, tmp_path):
    from tidemark import cli
    from tidemark.plans import acquisition

    base = {
        "ticker": "AAA", "filing_type": "10-Q", "currency": "USD", "filing_date": "January 30, 2026",
        "fiscal_period": "December 31, 2025", "balance_sheet": {"current_assets": 90.0, "total_liabilities": 40.0},
        "shares": {"common_M": 10.0}
    }
    rows = [base, base, base | {"ticker": "BBB", "currency": "CNY"}, base | {"ticker": "CCC"}]
    (tmp_path / "in.json").write_text(json.dumps(rows))
    (tmp_path / "p.csv").write_text("symbol,close\nAAA,5\nBBB,10\n")
    (tmp_path / "fx.csv").write_text("currency,per_usd\ncny,2\n")
    out = str(tmp_path / "screen.tsv")
    counts = cli.screen(
        [
            str(tmp_path / "in.json"), "--prices", str(tmp_path / "p.csv"), "--rates", str(tmp_path / "fx.csv"), "--as-of",
            "2026-02-01", "--output", out
        ],
        spark
    ).first()
    assert (counts.passed, counts.missing_price, counts.missing_price_tickers) == (2, 1, ["CCC"])
    lines_ = [r.value for r in spark.read.text(out).collect()]
    assert [x.split("\t")[0] for x in lines_] == ["ticker", "AAA", "BBB"] and lines_[1].split("\t")[3] == "100.0" and lines_[2].split("\t")[3] == "25.0"
    folder = tmp_path / "filings" / "AAA"
    folder.mkdir(parents=True)
    (folder / "AAA_10-Q_2026-01-30.htm").write_text("".join(f"<p>{x}</p>" for x in STATEMENT))
    cli.report(str(tmp_path / "filings"), str(tmp_path / "reports"), spark, latest=True)
    got = json.loads("".join(r.value for r in spark.read.text(str(tmp_path / "reports")).collect()))
    assert len(got) == 1 and list(got[0]) == list(reports.OUTPUT_FIELDS) and got[0]["revenue"] == 1e6
    known = spark.createDataFrame([("AAA", "0000000012")], "ticker string, cik string")
    assert sorted(
        (r.ticker, r.cik) for r in acquisition.with_cik(
            spark.createDataFrame([(" aaa",), ("B",)], "ticker string"), known
        ).collect()
    ) == [("AAA", "0000000012"), ("B", None)]
