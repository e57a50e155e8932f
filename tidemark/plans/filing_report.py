"""From filings to reports: tagged facts, statement lines and tables as candidates, one value for each metric, derived figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import latest_of, long_date, parse_date, quarter_end_like
from tidemark.functions.document_unit import document_unit, unit_evidence
from tidemark.functions.statements import plausible_eps
from tidemark.functions.text import company_name, filing_date_text, form_type, html_lines, normal_label, tag_text
from tidemark.functions.units import EPS_METRICS, composed_unit
from tidemark.operators.lookup import by_priority, matched_labels
from tidemark.operators.ranking import best_by
from tidemark.plans import facts, page_tables
from tidemark.plans.derive import derived
from tidemark.plans.statement_lines import statement_rows
from tidemark.session import kept

#: Metrics and their row labels, best first.
TEXT_LABELS = {
    "revenue": ["total revenue", "total revenues", "net revenue", "net revenues", "revenues"],
    "cogs": ["cost of revenue", "cost of revenues", "cost of sales", "costs of revenues"],
    "gross_profit": ["gross profit"],
    "operating_income": ["operating income", "income from operations", "operating profit"],
    "research_and_development": ["research and development"],
    "selling_and_marketing": ["selling and marketing", "sales and marketing", "selling expenses"],
    "general_and_administrative": ["general and administrative", "administrative expenses"],
    "pretax_income": ["income before income taxes", "income before tax", "profit before tax"],
    "tax_expense": ["income tax expense", "tax expense", "income tax benefit"],
    "net_income": ["net income", "net earnings", "profit for the period"],
    "interest_income": ["interest income", "investment income"],
    "total_assets": ["total assets"],
    "assets_current": ["total current assets"],
    "total_liabilities": ["total liabilities"],
    "liabilities_current": ["total current liabilities"],
    "equity": ["total equity", "total stockholders' equity", "total shareholders' equity"],
    "cash": ["cash and cash equivalents"],
    "short_term_investments": ["short-term investments", "short term investments"],
    "goodwill": ["goodwill"],
    "accounts_receivable": ["accounts receivable", "trade receivables"],
    "accounts_payable": ["accounts payable", "trade payables"],
    "deferred_revenue": ["deferred revenue", "contract liabilities"],
    "retained_earnings": ["retained earnings", "accumulated deficit"],
    "operating_cash_flow": ["net cash provided by operating activities", "net cash from operating activities"],
    "investing_cash_flow": ["net cash used in investing activities", "net cash from investing activities"],
    "financing_cash_flow": ["net cash provided by financing activities", "net cash from financing activities"],
    "depreciation_and_amortization": ["depreciation and amortization"],
    "share_based_compensation": ["share-based compensation", "stock-based compensation"],
    "capex": ["purchase of property and equipment", "purchases of property and equipment", "capital expenditures"],
    "acquisitions": ["payments to acquire businesses", "acquisitions"],
    "shares_outstanding": ["shares outstanding", "ordinary shares outstanding"],
    "weighted_avg_shares_basic": ["weighted average number of shares outstanding basic"],
    "weighted_avg_shares_diluted": ["weighted average number of diluted shares outstanding"],
}
#: Rows that mean something else than their label says.
UNWANTED = {"shares_outstanding": "weighted average", "net_income": "per share|per ads", "revenue": "cost of|deferred", "total_liabilities": "equity"}
#: Which statement a metric stands in; others may stand anywhere.
BALANCE = {
    "total_assets", "assets_current", "total_liabilities", "liabilities_current", "equity", "goodwill", "accounts_receivable",
    "accounts_payable", "deferred_revenue", "retained_earnings", "short_term_investments", "cash"
}
#: Metrics of an income statement, whose rows tell it from other tables of revenue.
INCOME = (
    "revenue", "cogs", "gross_profit", "operating_income", "research_and_development", "selling_and_marketing", "general_and_administrative",
    "pretax_income", "tax_expense", "net_income", "interest_income"
)
SOURCES = ("facts", "lines", "tables")
#: Metrics that text may not stand in for where tags are missing.
TAGGED_ONLY = ("shares_outstanding", "acquisitions")


def read_filings(filings: DataFrame) -> DataFrame:
    """(filing_id, name, ticker, raw) with form, dates and company; filings of no known form are dropped."""
    out = filings.withColumn("form_type", form_type(F.col("name"), F.col("raw"))).where("form_type is not null")
    out = out.withColumns(
        {
            "filed": parse_date(filing_date_text(F.col("name"), F.col("raw"))), "company_name": company_name(F.col("raw")),
            "lines": html_lines(F.col("raw"))
        }
    )
    return out.withColumn("target_end", period_end(F.col("raw"), F.array_join(F.slice("lines", 1, 400), "\n"), F.col("filed")))


def period_end(raw: Column, head: Column, filed: Column) -> Column:
    """A filing's period end: the tagged one, ``period ended ...``, or the newest date at a quarter's end that isn't past the filing."""
    tagged = parse_date(tag_text(raw, "dei:DocumentPeriodEndDate"))
    header = parse_date(F.regexp_extract(raw, r"(?i)CONFORMED PERIOD OF REPORT:\s*(\d{8})", 1))
    stated = parse_date(F.regexp_extract(head, r"(?i)(?:period|quarter|year|months)\s+ended:?\s+([A-Z][a-z]+\.?\s+\d{1,2},?\s+\d{4})", 1))
    every = F.transform(
        F.regexp_extract_all(
            head,
            F.lit(
                r"((?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},\s+\d{4})"
            ),
            1
        ),
        parse_date
    )
    past = F.filter(every, lambda d: d.isNotNull() & (filed.isNull() | (d <= filed)))
    return F.coalesce(tagged, header, stated, latest_of(past, quarter_end_like))


def label_dictionary(spark) -> DataFrame:
    """(metric, target, label_rank), 67 rows."""
    rows = [(m, label.replace("-", " "), k) for m, labels in TEXT_LABELS.items() for k, label in enumerate(labels)]
    return spark.createDataFrame(rows, "metric string, target string, label_rank int")


def labelled(rows: DataFrame, balance: Column) -> DataFrame:
    """The best row for each filing and metric: equal labels before longer ones, then the label's rank, then the first row.

    ``rows``: filing_id, ord, label, value; ``balance`` says whether a row is of a balance sheet.
    """
    named = rows.withColumns({"label": normal_label(F.col("label")), "_balance": balance}).where("label <> '' and value is not null")
    found = matched_labels(named, label_dictionary(rows.sparkSession), "prefix")
    for metric, pattern in UNWANTED.items():
        found = found.where((F.col("metric") != metric) | ~F.col("label").rlike(pattern))
    found = found.where(~F.col("metric").isin(*BALANCE) | F.col("_balance"))
    order = [(F.col("label") != F.col("target")).cast("int").asc(), F.col("label_rank").asc(), F.col("ord").asc()]
    return best_by(found, ["filing_id", "metric"], order).select("filing_id", "metric", "value")


def line_candidates(rows: DataFrame) -> DataFrame:
    """(filing_id, metric, value) of ``statement_rows``; amounts a share keep their scale."""
    scaled = rows.withColumn("value", F.when(normal_label(F.col("label")).rlike("per (share|ads)"), F.col("value")).otherwise(F.col("value") * F.col("scale")))
    return labelled(scaled.withColumnRenamed("row_no", "ord"), F.col("kind") == "balance")


def best_tables(filings: DataFrame) -> DataFrame:
    """The best HTML table of each filing and kind, see ``page_tables.best_tables``."""
    found = page_tables.page_tables(filings, "raw", ["filing_id"])
    fields = [[label.replace("-", " ") for label in TEXT_LABELS[m]] for m in INCOME]
    return page_tables.best_tables(page_tables.table_facts(found, ["filing_id"], fields), ["filing_id"])


def table_candidates(filings: DataFrame) -> DataFrame:
    """(filing_id, metric, value) of HTML tables, in units of currency."""
    rows = kept(best_tables(filings), "tables").select("filing_id", "kind", "latest", "to_millions", F.inline("rows"))
    value = F.coalesce(F.get("values", F.col("latest")), F.get("values", F.lit(0)))
    factor = F.when(normal_label(F.col("label")).rlike("per (share|ads)"), 1.0).otherwise(F.coalesce("to_millions", F.lit(1e-6)) * 1e6)
    return labelled(rows.select("filing_id", "kind", F.col("row_no").alias("ord"), "label", (value * factor).alias("value")), F.col("kind") == "BS")


def candidates(filings: DataFrame, rows: DataFrame) -> DataFrame:
    """(filing_id, metric, source, value) of all three sources; ``rows`` are the filings' ``statement_rows``."""
    ctx, found = kept(facts.contexts(filings), "contexts"), kept(facts.all_facts(filings), "facts")
    tagged = facts.chosen_metrics(filings, found, ctx).where("metric <> 'shares_outstanding'")
    shares = facts.chosen_shares(filings, found, ctx).select("filing_id", F.lit("shares_outstanding").alias("metric"), "value")
    some = tagged.unionByName(shares).withColumn("source", F.lit("facts"))
    for name, more in (("lines", line_candidates(rows)), ("tables", table_candidates(filings))):
        some = some.unionByName(more.where(~F.col("metric").isin(*TAGGED_ONLY)).withColumn("source", F.lit(name)))
    eps = F.col("metric").isin(*EPS_METRICS)
    return some.withColumn("value", F.when(eps, plausible_eps(F.col("value"))).otherwise(F.col("value")))


def units(rows: DataFrame, filings: DataFrame) -> DataFrame:
    """(filing_id, currency_unit): the currency of most of the ``statement_rows``' statements, the greatest code on ties; else what the document says."""
    counts = rows.where("currency is not null").select("filing_id", "section", "currency").distinct().groupBy("filing_id", "currency").agg(F.count("*").alias("n"))
    best = counts.groupBy("filing_id").agg(F.max(F.struct("n", "currency")).alias("m"))
    stated = best.select("filing_id", composed_unit(F.col("m.currency"), F.lit(None).cast("string")).alias("stated"))
    rest = filings.join(stated, "filing_id", "left_anti").select("filing_id", unit_evidence("raw", "lines").alias("evidence"))
    return stated.withColumnRenamed("stated", "currency_unit").unionByName(rest.select("filing_id", document_unit(F.col("evidence")).alias("currency_unit")))


def reports(filings: DataFrame) -> DataFrame:
    """One derived report for each filing of (filing_id, name, ticker, raw).

    What is read out of the texts is written once, in narrow tables: the rows
    of statements, the tagged facts and their contexts, the best HTML tables.
    """
    read = read_filings(filings)
    rows = kept(statement_rows(read, "filing_id"), "statement-rows")
    chosen = by_priority(candidates(read, rows), ["filing_id", "metric"], "source", "value", SOURCES)
    wide = facts.report_columns(chosen)
    head = read.select(
        "filing_id", "ticker", "company_name", "form_type", long_date(F.col("filed")).alias("filing_date"),
        long_date(F.col("target_end")).alias("period_end_date")
    )
    return derived(head.join(units(rows, read), "filing_id", "left").join(wide, "filing_id", "left"))


def latest_reports(found: DataFrame, legacy_string_order: bool = False) -> DataFrame:
    """The latest report of each ticker and form, by period end, else filing date; the last one wins ties.

    ``legacy_string_order`` compares the filing dates' texts instead, so that
    April stands before March.
    """
    day = F.col("filing_date") if legacy_string_order else F.coalesce(parse_date(F.col("period_end_date")), parse_date(F.col("filing_date")))
    return best_by(found, ["ticker", "form_type"], [day.desc_nulls_last(), F.col("filing_id").desc()])
