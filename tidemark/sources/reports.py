"""Reports and tables as text, CSV and JSON files.

Reports have the size of a screen's result, so they are written as one file;
``ord`` orders their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import human
from tidemark.functions.text import wide_line
from tidemark.plans.facts import METRIC_TAGS

BOM = "﻿"
RATIOS = (
    "gross_margin", "operating_margin", "net_margin", "ebitda_margin", "return_on_equity", "return_on_assets", "current_ratio",
    "debt_to_equity", "asset_turnover"
)
HEAD = ("file_path", "ticker", "company_name", "form_type", "form_explanation", "filing_date", "period_end_date", "currency_unit")
#: The metrics of a report in the order of the flat output.
METRICS = (
    "revenue", "cogs", "gross_profit", "operating_income", "research_and_development", "selling_and_marketing",
    "general_and_administrative", "sga", "pretax_income", "tax_expense", "net_income", "ebitda", "interest_income", "eps_basic",
    "eps_diluted", "total_assets", "assets_current", "total_liabilities", "liabilities_current", "equity", "cash",
    "short_term_investments", "goodwill", "accounts_receivable", "accounts_payable", "deferred_revenue", "retained_earnings",
    "operating_cash_flow", "investing_cash_flow", "financing_cash_flow", "free_cash_flow", "depreciation_and_amortization",
    "share_based_compensation", "capex", "acquisitions", "shares_outstanding", "weighted_avg_shares_basic",
    "weighted_avg_shares_diluted"
)
OUTPUT_FIELDS = (*HEAD, *METRICS, *RATIOS)
#: The parts of the nested output and their fields.
NESTED = {
    "income_statement": ("revenue", "cogs", "gross_profit", "operating_income", "research_and_development", "selling_and_marketing", "general_and_administrative", "sga", "pretax_income", "tax_expense", "net_income", "ebitda", "interest_income", "eps_basic", "eps_diluted"),
    "balance_sheet": ("total_assets", "assets_current", "total_liabilities", "liabilities_current", "equity", "cash", "short_term_investments", "goodwill", "accounts_receivable", "accounts_payable", "deferred_revenue", "retained_earnings"),
    "cash_flow": ("operating_cash_flow", "investing_cash_flow", "financing_cash_flow", "free_cash_flow", "depreciation_and_amortization", "share_based_compensation", "capex", "acquisitions"),
    "shares": ("shares_outstanding", "weighted_avg_shares_basic", "weighted_avg_shares_diluted"),
    "ratios": RATIOS,
}
assert {m if m != "ebitda_direct" else "ebitda" for m in METRIC_TAGS} <= set(METRICS)


def with_fields(df: DataFrame, fields: tuple[str, ...] = OUTPUT_FIELDS) -> DataFrame:
    """All fields in order, missing ones as null."""
    none = lambda f: F.lit(None).cast("string" if f in HEAD else "double").alias(f)
    return df.select(*(F.col(f) if f in df.columns else none(f) for f in fields))


def csv_lines(df: DataFrame, columns: list[str], bom: bool = True, sep: str = ",") -> DataFrame:
    """(ord, value): a header line and one line for each row, quoted where needed; ``df`` has a column ``ord``."""

    def cell(name: str) -> Column:
        text = F.col(name).cast("string")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(text.rlike(f'[{sep}"\n\r]'), quoted).otherwise(text), F.lit(""))

    rows = df.select(F.col("ord").cast("long"), F.concat_ws(sep, *(cell(c) for c in columns)).alias("value"))
    head = df.sparkSession.createDataFrame([(-1, (BOM if bom else "") + sep.join(columns))], "ord long, value string")
    return head.union(rows)


def json_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    """One JSON object to a row, nulls kept, fields in the given order."""
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def json_array(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: all rows as a JSON array, in the order of ``ord``."""
    each = df.select("ord", F.struct(*columns).alias("o"))
    ordered = each.agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "o"))), lambda x: x["o"]).alias("a"))
    return ordered.select(F.to_json("a", {"ignoreNullFields": "false"}).alias("value"))


def nested(df: DataFrame) -> DataFrame:
    """Reports with their metrics in the parts of ``NESTED``."""
    whole = with_fields(df, (*HEAD, *METRICS, *RATIOS)) if "ord" not in df.columns else df.select(
        "ord", *(c for c in with_fields(df).columns if c in df.columns)
    )
    part = lambda fields: F.struct(*((F.col(f) if f in whole.columns else F.lit(None).cast("double")).alias(f) for f in fields))
    kept = [c for c in ("ord", "ticker", "form_type", "company_name", "currency_unit", "filing_date", "period_end_date") if c in whole.columns]
    return whole.select(*kept, *(part(fields).alias(name) for name, fields in NESTED.items()))


def candidate_line() -> Column:
    """A line of the surplus screen's text report."""
    return F.format_string("%-8s %10s %10s %8.2f%%", "ticker", human(F.col("surplus")), human(F.col("market_cap")), "surplus_pct_of_mcap")


def report_format(path: str, asked: str | None = None) -> str:
    """What was asked for, else what the suffix says, else txt."""
    suffix = path.rpartition(".")[2].lower()
    return asked or (suffix if suffix in ("csv", "tsv") else "txt")


def screen_report(found: DataFrame, kind: str) -> DataFrame:
    """(ord, value) of ranked candidates (ord, ticker, surplus, market_cap, surplus_pct_of_mcap) as txt, tsv or csv."""
    columns = ["ticker", "surplus", "market_cap", "surplus_pct_of_mcap"]
    if kind != "txt":
        return csv_lines(found, columns, bom=kind == "csv", sep="\t" if kind == "tsv" else ",")
    head = found.sparkSession.createDataFrame([(-1, f"{'ticker':<8} {'surplus':>10} {'market cap':>10} {'share':>9}")], "ord long, value string")
    return head.union(found.select(F.col("ord").cast("long"), candidate_line()))


def price_lines(prices: DataFrame) -> DataFrame:
    """(ord, value) of (symbol, close): CSV by symbol, six decimals."""
    rows = prices.select(F.col("symbol").alias("ord"), F.format_string("%s,%.6f", "symbol", "close").alias("value"))
    return prices.sparkSession.createDataFrame([("", "symbol,close")], "ord string, value string").union(rows)


def forward_pe_lines(found: DataFrame) -> DataFrame:
    """(ord, value): what passed the forward P/E screen as CSV, cheapest first, earnings a share with four decimals."""
    passed = found.where("status = 'passed'").withColumn("eps_usd", F.round("eps_usd", 4))
    ranked = passed.orderBy(F.col("forward_pe").asc_nulls_last(), "ticker").withColumn("ord", F.monotonically_increasing_id())
    return csv_lines(ranked, ["ticker", "forward_pe", "eps_type", "eps_usd", "price", "net_cash_m"])


def boxed(width: int = 70) -> Column:
    """A report as a box of lines: a head, and its metrics side by side."""
    rule = F.lit("=" * width)
    money = lambda m: F.when(F.col(m).isNull(), "-").otherwise(human(F.col(m)))
    pairs = [("revenue", "net_income"), ("gross_profit", "ebitda"), ("total_assets", "total_liabilities"), ("cash", "equity"), ("operating_cash_flow", "capex")]
    lines = [wide_line([(F.lit(a), money(a)), (F.lit("  " + b), money(b))], 20, 12) for a, b in pairs]
    head = F.concat_ws("  ", "ticker", "form_type", "period_end_date")
    return F.concat_ws("\n", rule, head, rule, *lines, rule)


def write_text(lines: DataFrame, path: str) -> None:
    """Write ordered lines as one file; for reports, whose size is that of a screen's result."""
    lines.repartitionByRange(1, "ord").sortWithinPartitions("ord").select("value").write.mode("overwrite").text(path)


def progress_map(done: DataFrame) -> DataFrame:
    """One row: (ticker, status, form, file, date, reason) as the JSON map of a progress file, tickers in order."""
    entry = F.struct(F.col("ticker").alias("key"), F.struct(*(c for c in ("status", "form", "file", "date", "reason") if c in done.columns)).alias("value"))
    return done.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("value"))


def by_ticker_and_form(found: DataFrame) -> DataFrame:
    """Reports in the order of their output."""
    return found.orderBy("ticker", "form_type")


def first_reasons(found: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` reasons why tickers were skipped, in input order."""
    return found.where("status = 'skipped'").orderBy("ord").limit(n).select("ord", "ticker", "reason")
