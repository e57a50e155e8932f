"""Screen: current assets above all liabilities, ranked by the surplus against market value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import effective_date
from tidemark.functions.units import composed_unit, currency_code
from tidemark.operators.funnel import funnel, gate
from tidemark.operators.ranking import best_by, filled

QUALITY = ("assets_current", "total_liabilities", "shares_outstanding", "shares_outstanding_ads_equivalent", "ordinary_shares_per_ads", "currency_unit")
STOPS = ("missing_shares", "missing_fx", "missing_price", "no_market_cap", "below_market_cap")
LEAST_MARKET_CAP = 30_000_000.0
#: The nested input's fields (in millions) and their flat names.
NESTED = {
    "revenue": "income_statement.revenue", "ebitda": "income_statement.ebitda", "net_income": "income_statement.net_income",
    "total_assets": "balance_sheet.total_assets", "assets_current": "balance_sheet.current_assets",
    "total_liabilities": "balance_sheet.total_liabilities", "liabilities_current": "balance_sheet.current_liabilities"
}
_MONEY = "struct<{}>".format(",".join(f"{c}:double" for c in ("revenue", "ebitda", "net_income")))
INPUT_SCHEMA = (
    "ord long, file_path string, ticker string, company_name string, form_type string, filing_type string, filing_date string, period_end_date string, fiscal_period string, currency string, currency_unit string,"
    "revenue double, ebitda double, net_income double, total_assets double, assets_current double, total_liabilities double, liabilities_current double, shares_outstanding double,"
    f"income_statement {_MONEY}, balance_sheet struct<total_assets:double,current_assets:double,total_liabilities:double,current_liabilities:double>,"
    "cash_flow struct<operating_cf:double>, ratios struct<current_ratio:double>, shares struct<common_M:double,weighted_avg_M:double,diluted_M:double,ads_per_share:double,ordinary_shares_per_ads:double,ads_per_ordinary_share:double>"
)


def _nonzero(x: Column) -> Column:
    return F.when(x != 0, x)


def normalised(records: DataFrame) -> DataFrame:
    """Nested records (amounts in millions) and flat ones in one flat form; ``ord`` is the input order."""
    nested = F.coalesce(*(F.col(c).isNotNull() for c in ("income_statement",)), F.lit(False))
    for c in ("balance_sheet", "cash_flow", "shares", "ratios"):
        nested = nested | F.col(c).isNotNull()
    per_ads, per_share, legacy = (_nonzero(F.col(f"shares.{c}")) for c in ("ordinary_shares_per_ads", "ads_per_ordinary_share", "ads_per_share"))
    ordinary = F.coalesce(per_ads, 1 / per_share, F.when(legacy >= 1, legacy).otherwise(1 / legacy))
    depositary = F.coalesce(1 / per_ads, per_share, F.when(legacy >= 1, 1 / legacy).otherwise(legacy))
    common = F.col("shares.common_M")
    flat = {k: F.when(nested, F.col(v) * 1e6).otherwise(F.col(k)) for k, v in NESTED.items()}
    return records.select(
        "ord", "file_path", "ticker", "company_name",
        F.when(nested, F.coalesce(F.nullif("filing_type", F.lit("")), "form_type")).otherwise(F.col("form_type")).alias("form_type"), "filing_date",
        F.when(nested, F.coalesce(F.nullif("fiscal_period", F.lit("")), "period_end_date")).otherwise(F.col("period_end_date")).alias("period_end_date"),
        F.when(nested, composed_unit(F.col("currency"), F.lit("millions(dom)"))).otherwise(F.col("currency_unit")).alias("currency_unit"),
        *(e.alias(k) for k, e in flat.items()),
        F.when(nested, common * 1e6).otherwise(F.col("shares_outstanding")).alias("shares_outstanding"),
        F.when(nested, common * depositary * 1e6).alias("shares_outstanding_ads_equivalent"), F.when(nested, ordinary).alias("ordinary_shares_per_ads"),
    )


def _key(c: str) -> Column:
    return F.upper(F.trim(F.coalesce(F.col(c), F.lit(""))))


def deduplicated(records: DataFrame) -> DataFrame:
    """The fullest record of each (ticker, form, filing date, period); a folder named like the ticker is preferred, the first one wins ties.

    Records are dealt out by ticker, in ``_t``, which ``latest`` uses again.
    """
    folder, ticker = F.upper(F.regexp_extract("file_path", "([^/]+)/[^/]+$", 1)), F.upper(F.coalesce("ticker", F.lit("")))
    prefer = F.when(F.coalesce(F.col("file_path"), F.lit("")) == "", 1).when(folder == ticker, 3).when(folder.rlike("(W|WS|WT)$"), 0).otherwise(2)
    keyed = records.withColumns(
        {
            "_t": _key("ticker"), "_f": _key("form_type"), "_d": F.trim(F.coalesce("filing_date", F.lit(""))),
            "_p": F.trim(F.coalesce("period_end_date", F.lit("")))
        }
    )
    return best_by(keyed.repartition("_t"), ["_t", "_f", "_d", "_p"], [filled(QUALITY).desc(), prefer.desc(), F.col("ord").asc()]).drop("_f", "_d", "_p")


def dated(records: DataFrame) -> DataFrame:
    """Records with their effective date, and ``_t``, the ticker's key; those without a ticker are dropped."""
    out = records.withColumn("effective", effective_date(F.col("period_end_date"), F.col("filing_date")))
    return (out if "_t" in records.columns else out.withColumn("_t", _key("ticker"))).where("_t <> ''")


def latest(records: DataFrame) -> DataFrame:
    """The latest record of each ticker by effective date, then fullness; the first one wins ties."""
    return best_by(dated(records), ["_t"], [F.col("effective").desc_nulls_last(), filled(QUALITY).desc(), F.col("ord").asc()]).drop("_t")


def fresh(records: DataFrame, as_of: Column, days: int = 730) -> DataFrame:
    """Drop records older than ``days``; undated ones stay, and 0 days keeps all."""
    if days <= 0:
        return records
    return records.where(F.col("effective").isNull() | (F.col("effective") >= F.date_sub(as_of, days)))


def gated(records: DataFrame, prices: DataFrame, fx: DataFrame) -> DataFrame:
    """Records whose current assets exceed liabilities, with market figures in USD and the gate each one stops at.

    ``prices``: ticker, price; ``fx``: currency, usd_per_unit (USD is always 1).
    """
    rates = fx.where("currency <> 'USD'").select("currency", "usd_per_unit").union(
        fx.sparkSession.createDataFrame([("USD", 1.0)], "currency string, usd_per_unit double")
    )
    match = records.withColumn("ticker", _key("ticker")).where(
        "ticker <> '' and assets_current > total_liabilities"
    ).withColumn("currency", currency_code(F.col("currency_unit")))
    joined = match.join(rates, "currency", "left").join(prices.select("ticker", "price"), "ticker", "left")
    cap = F.col("shares_outstanding") * F.col("price")
    usd = {c: F.col(c) * F.col("usd_per_unit") for c in ("assets_current", "total_liabilities", "ebitda", "net_income")}
    out = joined.withColumns({"market_cap": cap, **usd}).withColumn("surplus", F.col("assets_current") - F.col("total_liabilities"))
    stops = [
        F.col("shares_outstanding").isNull(), F.col("usd_per_unit").isNull(), F.col("price").isNull(), F.col("market_cap") <= 0,
        F.col("market_cap") < LEAST_MARKET_CAP
    ]
    return out.withColumns(
        {
            "gate": gate(list(zip(STOPS, stops, strict=True))),
            "surplus_pct_of_mcap": F.col("surplus") / F.nullif("market_cap", F.lit(0.0)) * 100.0
        }
    )


def screen(records: DataFrame, prices: DataFrame, fx: DataFrame, as_of: Column, days: int = 730) -> DataFrame:
    """Raw records to the ranked candidates."""
    found = gated(fresh(latest(deduplicated(normalised(records))), as_of, days), prices, fx)
    return found.where("gate = 'passed'").orderBy(F.col("surplus_pct_of_mcap").desc(), "ord")


def screen_funnel(found: DataFrame) -> DataFrame:
    """Counts at each gate, and the tickers without a price."""
    return funnel(found, [*STOPS, "passed"]).crossJoin(
        found.where("gate = 'missing_price'").agg(F.sort_array(F.collect_set("ticker")).alias("missing_price_tickers"))
    )
