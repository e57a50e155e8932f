"""Parsing, facts, screens and incremental runs on small hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text, units
from tidemark.operators import sections
from tidemark.plans import acquisition, derive, exhibits, facts, forward_pe, net_current_assets
from tidemark.sources import files, reports, vendor
from tidemark.streaming.incremental import newest_version, run_incrementally


def values(spark, data, expr):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(data)], "i int, x string")
    return [r.v for r in df.select("i", expr(F.col("x")).alias("v")).orderBy("i").collect()]


def test_number_notation(spark):
    data = ["(1,234.5)", "US$2.5M", "—", "12B", "N/A", "1d", None, "", "( 3 )", "$7k", "--", "(", "-4", "1e3", "1_0"]
    assert values(spark, data, numbers.parse_number) == [-1234.5, 2.5e6, None, 1.2e10, None, None, None, None, -3.0, 7000.0, None, None, -4.0, 1000.0, None]


def test_half_even_on_the_binary_value(spark):
    data = [2.675, 0.125, 2.5, -2.675, 1.005, 0.375, 1e6 / 3, *(k / 200 for k in range(1, 400, 7))]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(data)], "i int, x double")
    assert [r.v for r in df.select("i", numbers.half_even(F.col("x"), 2).alias("v")).orderBy("i").collect()] == [round(x, 2) for x in data]


def test_dates(spark):
    import datetime as d

    day = d.date(2025, 12, 31)
    assert values(
        spark, ["2025-12-31", "2025/12/31", "20251231", "December 31, 2025", "Dec. 31, 2025", "soon", None], dates.parse_date
    ) == [day] * 5 + [None, None]
    assert values(spark, ["Sept 30, 2025"], dates.parse_date) == [d.date(2025, 9, 30)]
    df = spark.createDataFrame(
        [("December 31", "January 15, 2026"), ("March 31", "2026-04-20"), (None, "2026-04-20"), ("2026-01-05", None)],
        "p string, f string"
    )
    assert [
        r.v for r in df.select(dates.effective_date(F.col("p"), F.col("f")).alias("v")).collect()
    ] == [day, d.date(2026, 3, 31), d.date(2026, 4, 20), d.date(2026, 1, 5)]


def test_effective_dates_on_leap_days(spark):
    import datetime as d

    rows = [
        ("February 29", "December 31, 1995"), ("Feb 29", "March 05, 1996"), ("February 29", "January 05, 1996"),
        ("1996-02-29", "December 31, 1995"), ("February 29, 1996", "March 05, 1996"), ("February 28", "March 05, 1996")
    ]
    df = spark.createDataFrame(rows, "p string, f string")
    got = [r.v for r in df.select(dates.effective_date(F.col("p"), F.col("f")).alias("v")).collect()]
    assert got == [d.date(1995, 12, 31), d.date(1996, 3, 5), d.date(1996, 1, 5), d.date(1996, 2, 29), d.date(1996, 2, 29), d.date(1996, 2, 28)]


def test_units_and_labels(spark):
    assert values(
        spark, ["RMB, millions", "NEW TAIWAN DOLLARS", None, "Brazilian", "millions(dom)"], units.currency_code
    ) == ["CNY", "NEW", "USD", "BRL", "DOM"]
    assert values(spark, ["Net income—basic (per ADS): 1,2"], text.normal_label) == ["net income basic per ads 1 2"]
    assert values(spark, ["per ADS, each two ordinary shares", "ordinary shares per ADS", "per share"], text.depositary_first) == [True, False, False]


def test_lines_and_documents(spark):
    assert values(spark, ["<p>A &amp; B<br>c</p><script>x</script> <b>d</b>  e"], text.html_lines) == [["A & B", "c", "d e"]]
    raw = "<DOCUMENT><TYPE>6-K\n<TEXT>cover</TEXT></DOCUMENT><DOCUMENT><TYPE>EX-99.1\n<FILENAME>ex99-1.htm\n<DESCRIPTION>EARNINGS RELEASE\n<TEXT>Third quarter results. Net income rose. Total assets fell.</TEXT></DOCUMENT>"
    df = spark.createDataFrame([("a", raw), ("b", "none")], "filing_id string, raw string")
    first, second = exhibits.chosen_exhibits(exhibits.scored_exhibits(df))
    assert [(r.filing_id, r.type, r.filename) for r in first.collect()] == [("a", "EX-99.1", "ex99-1.htm")]
    assert second.count() == 1


def test_line_helpers(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)], "l array<string>")
    got = [(w.at, w.n, w.text) for w in df.select(sections.line_windows(F.col("l"), 2).alias("w")).first().w]
    assert got == [(0, 1, "a"), (1, 1, "b"), (2, 1, "c"), (0, 2, "a b"), (1, 2, "b c")]
    df = spark.createDataFrame([(["(12", ")", "5", "(7)", ")"],), ([],)], "l array<string>")
    assert [r.m for r in df.select(sections.merged_parentheses(F.col("l")).alias("m")).collect()] == [["(12)", "5", "(7)", ")"], []]


IXBRL = """<xbrli:context id="c-1"><xbrli:period><xbrli:startDate>2025-10-01</xbrli:startDate><xbrli:endDate>2025-12-31</xbrli:endDate></xbrli:period></xbrli:context>
<xbrli:context id="c-2"><xbrli:period><xbrli:startDate>2025-01-01</xbrli:startDate><xbrli:endDate>2025-12-31</xbrli:endDate></xbrli:period></xbrli:context>
<xbrli:context id="c-3"><xbrli:period><xbrli:instant>2025-12-31</xbrli:instant></xbrli:period></xbrli:context>
<xbrli:context id="c-4"><xbrli:entity><xbrldi:explicitMember>A</xbrldi:explicitMember></xbrli:entity><xbrli:period><xbrli:instant>2025-12-31</xbrli:instant></xbrli:period></xbrli:context>
<xbrli:context id="c-5"><xbrli:entity><xbrldi:explicitMember>B</xbrldi:explicitMember></xbrli:entity><xbrli:period><xbrli:instant>2025-12-31</xbrli:instant></xbrli:period></xbrli:context>
<ix:nonFraction name="us-gaap:Revenues" contextRef="c-1" unitRef="usd" scale="6">143</ix:nonFraction>
<ix:nonFraction name="us-gaap:Revenues" contextRef="c-2" unitRef="usd" scale="6">500</ix:nonFraction>
<ix:nonFraction name="us-gaap:Assets" contextRef="c-3" unitRef="usd" scale="6">900</ix:nonFraction>
<ix:nonFraction name="us-gaap:NetIncomeLoss" contextRef="c-1" sign="-" scale="6">12</ix:nonFraction>
<ix:nonFraction name="dei:EntityCommonStockSharesOutstanding" contextRef="c-4">10</ix:nonFraction>
<ix:nonFraction name="dei:EntityCommonStockSharesOutstanding" contextRef="c-5">5</ix:nonFraction>
<us-gaap:Liabilities contextRef="c-3">40</us-gaap:Liabilities><us-gaap:Liabilities contextRef="c-3">40</us-gaap:Liabilities>"""


def test_facts(spark):
    df = spark.createDataFrame(
        [("f", IXBRL, "10-Q")], "filing_id string, raw string, form_type string"
    ).withColumn("target_end", F.to_date(F.lit("2025-12-31")))
    ctx, found = facts.contexts(df), facts.all_facts(df)
    assert ctx.count() == 5 and found.where("name = 'us-gaap:Liabilities'").count() == 1
    got = {r.metric: r.value for r in facts.chosen_metrics(df, found, ctx).collect()}
    assert (got["revenue"], got["total_assets"], got["net_income"], got["total_liabilities"]) == (143e6, 900e6, -12e6, 40.0)
    assert [r.value for r in facts.chosen_shares(df, found, ctx).collect()] == [15.0]
    wide = derive.derived(facts.report_columns(facts.chosen_metrics(df, found, ctx))).first()
    assert wide.equity == 900e6 - 40 and wide.net_margin == pytest.approx(-12 / 143)


def test_identities_of_derived_figures(spark):
    row = {
        "revenue": 100.0, "cogs": -60.0, "pretax_income": 30.0, "tax_expense": -5.0, "net_income": 25.0, "operating_income": 20.0,
        "depreciation_and_amortization": 4.0, "ebitda": 90.0, "operating_cash_flow": 9.0, "capex": 3.0,
        "selling_and_marketing": 1.0, "weighted_avg_shares_diluted": 8.0
    }
    d = derive.derived(spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} double" for k in row))).first()
    assert (d.gross_profit, d.tax_expense, d.ebitda, d.capex, d.free_cash_flow, d.sga, d.shares_outstanding) == (40.0, 5.0, 24.0, -3.0, 6.0, 1.0, 8.0)


def test_surplus_screen(spark, tmp_path):
    base = {
        "ticker": "AAA", "filing_type": "10-Q", "company_name": "Alpha", "currency": "USD", "filing_date": "January 30, 2026",
        "fiscal_period": "December 31, 2025", "income_statement": {"revenue": 100.0, "ebitda": 20.0, "net_income": 12.0},
        "balance_sheet": {"current_assets": 90.0, "total_liabilities": 40.0}, "shares": {"common_M": 10.0}
    }
    rows = [
        base, base | {"ticker": "BBB", "currency": None},
        base | {"ticker": "CCC", "balance_sheet": {"current_assets": 40.0, "total_liabilities": 40.0}}, base | {"ticker": "DDD"}
    ]
    (tmp_path / "in.json").write_text(json.dumps([r | {"ord": i} for i, r in enumerate(rows)]))
    (tmp_path / "p.csv").write_text("Symbol;Close\naaa.us;4.0\nAAA;5.0\nBBB;0\nddd;2\n")
    records = spark.read.schema(net_current_assets.INPUT_SCHEMA).json(str(tmp_path / "in.json"), multiLine=True)
    prices = files.prices(spark, str(tmp_path / "p.csv"))
    assert {r.ticker: r.price for r in prices.collect()} == {"AAA": 5.0, "DDD": 2.0}
    fx = files.exchange_rates(spark.createDataFrame([("CNY", 7.0), ("BAD", 0.0)], "currency string, per_usd double"))
    flat = net_current_assets.normalised(records)
    found = net_current_assets.gated(net_current_assets.latest(net_current_assets.deduplicated(flat)), prices, fx)
    assert {r.ticker: r.gate for r in found.collect()} == {"AAA": "passed", "BBB": "missing_fx", "DDD": "below_market_cap"}
    top = net_current_assets.screen(records, prices, fx, F.to_date(F.lit("2026-02-01"))).collect()
    assert [(r.ticker, r.surplus, r.market_cap, r.surplus_pct_of_mcap) for r in top] == [("AAA", 50e6, 50e6, 100.0)]
    assert net_current_assets.screen(records, prices, fx, F.to_date(F.lit("2029-02-01"))).count() == 0
    counts = net_current_assets.screen_funnel(found).first()
    assert (counts.passed, counts.missing_fx, counts.missing_price_tickers) == (1, 1, [])
    ratio = records.where("ticker = 'AAA'").withColumn(
        "shares",
        F.expr(
            "named_struct('common_M', 10D, 'weighted_avg_M', null, 'diluted_M', null, 'ads_per_share', 0.2D, 'ordinary_shares_per_ads', null, 'ads_per_ordinary_share', null)"
        ).cast(
            "struct<common_M:double,weighted_avg_M:double,diluted_M:double,ads_per_share:double,ordinary_shares_per_ads:double,ads_per_ordinary_share:double>"
        )
    )
    assert net_current_assets.normalised(ratio).first().ordinary_shares_per_ads == 5.0


SUMMARY = '<ReportFinancialSummary><EPSs currency="CNY"><EPS asofDate="2025-09-30" reportType="TTM" period="12M">73.36</EPS><EPS asofDate="2025-12-31" reportType="P" period="12M">0</EPS></EPSs></ReportFinancialSummary>'
SNAPSHOT = '<ReportSnapshot><Ratios ExchangeRate="0.14618" ReportingCurrency="CNY" PriceCurrency="USD"><Group ID="Price and Volume"><Ratio FieldName="NPRICE">105.39</Ratio><Ratio FieldName="EV">88437</Ratio></Group><Group ID="Income Statement"><Ratio FieldName="MKTCAP">149616</Ratio></Group><Group ID="Other"><Ratio FieldName="PEEXCLXOR">-99999.99</Ratio></Group></Ratios></ReportSnapshot>'


def test_forward_pe_screen(spark):
    df = spark.createDataFrame([("PDD", SUMMARY, SNAPSHOT), ("BAD", "<x", None)], "ticker string, a string, b string")
    out = forward_pe.screened(df.withColumns(vendor.eps_columns(F.col("a")) | vendor.snapshot_columns(F.col("b"))))
    rows = {r.ticker: r for r in out.collect()}
    assert (rows["PDD"].status, rows["PDD"].forward_pe, rows["PDD"].net_cash_m, rows["PDD"].eps_type) == ("passed", 9.83, 61179.0, "trailing")
    assert rows["BAD"].status == "skipped"
    assert forward_pe.summary(out).first().mean_pe == 9.83


def test_cache_boundary(spark):
    cache = spark.createDataFrame([("a", "2026-01-01T00:00:00"), ("b", "2026-01-02T00:00:00"), ("c", "2025-12-31T00:00:00")], "k string, fetched_at string")
    now = F.lit("2026-02-15 00:00:00").cast("timestamp")
    assert sorted(r.k for r in vendor.cached(cache, now).collect()) == ["a", "b"]
    assert tuple(vendor.cache_stats(cache, now).first()) == (3, 1, 2)


def test_acquisition(spark, tmp_path):
    (tmp_path / "t.txt").write_text("# list\n aaa \n\nFiVN\n")
    assert [r.ticker for r in files.tickers(spark, str(tmp_path / "t.txt")).orderBy("ord").collect()] == ["AAA", "FIVN"]
    (tmp_path / "p.json").write_text(json.dumps({"AAA": {"status": "ok"}, "BBB": {"status": "error"}}))
    left = acquisition.pending(spark.createDataFrame([("AAA",), ("BBB",), ("CCC",)], "ticker string"), files.progress(spark, str(tmp_path / "p.json")))
    assert sorted(r.ticker for r in left.collect()) == ["BBB", "CCC"]
    (tmp_path / "s.json").write_text(
        json.dumps(
            {
                "filings": {
                    "recent": {
                        "form": ["10-Q", "10-K", "10-Q"], "accessionNumber": ["1", "2", "3"], "primaryDocument": ["a", "b", "c"],
                        "filingDate": ["2026-01-02", "2026-01-01", "2026-01-02"]
                    }
                }
            }
        )
    )
    assert acquisition.latest_of_forms(files.submissions(spark, str(tmp_path / "s.json")), ("10-K", "10-Q")).first().accession == "1"
    (tmp_path / "c.json").write_text(json.dumps({"0": {"ticker": "aaa", "cik_str": 12}}))
    assert tuple(files.company_tickers(spark, str(tmp_path / "c.json")).first()) == ("AAA", "0000000012")
    (tmp_path / "m.idx").write_text(
        "CIK|Company|Form|Date|path\n1000001|ALPHA|6-K|2026-01-15|edgar/data/1000001/0001000001-26-000001.txt\n1000001|ALPHA|6-K|2026-02-20|edgar/data/1000001/0001000001-26-000002.txt\n"
    )
    assert [r.accession for r in acquisition.newest_6k(files.master_index(spark, str(tmp_path / "m.idx")), 1).collect()] == ["0001000001-26-000002"]


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(0, 'a,"b', None), (1, "c", 2.0)], "ord int, n string, v double")
    reports.write_text(reports.csv_lines(df, ["n", "v"]), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).collect()[1].value == '"a,""b",'
    assert reports.json_lines(df, ["v", "n"]).collect()[1].value == '{"v":2.0,"n":"c"}'


def test_incremental_upserts(spark, tmp_path):
    for i, rows in enumerate(([("a", 1), ("b", 1)], [("b", 2), ("c", 2)])):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("k string, v int").parquet(str(tmp_path / "in"))
        run_incrementally(stream, lambda d: d, str(tmp_path / "out"), ["k"], str(tmp_path / "cp")).awaitTermination()
        assert newest_version(spark, str(tmp_path / "out")) == i + 1
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out/v2")).collect())) == [("a", 1), ("b", 2), ("c", 2)]
