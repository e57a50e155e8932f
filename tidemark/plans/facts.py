"""Tagged facts of filings, and the choice of one value for each metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import parse_date, preferred_duration
from tidemark.functions.numbers import parse_number
from tidemark.functions.text import clean_text
from tidemark.operators.lookup import union_missing

#: Metrics and their tags, best first.
METRIC_TAGS = {
    "revenue": ["us-gaap:RevenueFromContractWithCustomerExcludingAssessedTax", "us-gaap:Revenues", "us-gaap:SalesRevenueNet", "ifrs-full:Revenue", "ifrs-full:RevenueFromContractsWithCustomers"],
    "cogs": ["us-gaap:CostOfGoodsAndServicesSold", "us-gaap:CostOfRevenue", "ifrs-full:CostOfSales", "ifrs-full:CostOfGoodsSold"],
    "gross_profit": ["us-gaap:GrossProfit", "ifrs-full:GrossProfit"],
    "operating_income": ["us-gaap:OperatingIncomeLoss", "ifrs-full:ProfitLossFromOperatingActivities", "ifrs-full:OperatingProfitLoss"],
    "research_and_development": ["us-gaap:ResearchAndDevelopmentExpense", "ifrs-full:ResearchAndDevelopmentExpense"],
    "selling_and_marketing": ["us-gaap:SellingAndMarketingExpense", "ifrs-full:SellingAndDistributionExpense", "ifrs-full:SalesAndMarketingExpense"],
    "general_and_administrative": ["us-gaap:GeneralAndAdministrativeExpense", "ifrs-full:AdministrativeExpense", "ifrs-full:GeneralAndAdministrativeExpense"],
    "sga": ["us-gaap:SellingGeneralAndAdministrativeExpense"],
    "pretax_income": ["us-gaap:IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest", "us-gaap:IncomeBeforeTax", "ifrs-full:ProfitLossBeforeTax"],
    "tax_expense": ["us-gaap:IncomeTaxExpenseBenefit", "ifrs-full:IncomeTaxExpenseContinuingOperations"],
    "net_income": ["us-gaap:NetIncomeLoss", "us-gaap:ProfitLoss", "ifrs-full:ProfitLoss"],
    "interest_income": ["us-gaap:InterestIncomeOperating", "us-gaap:InvestmentIncomeInterest", "us-gaap:InterestIncomeExpenseNonoperatingNet", "us-gaap:InterestAndOtherIncome", "ifrs-full:FinanceIncome", "ifrs-full:InterestRevenueExpense"],
    "ebitda_direct": ["us-gaap:EarningsBeforeInterestTaxesDepreciationAndAmortization", "us-gaap:EarningsBeforeInterestTaxesAndDepreciationAndAmortization", "ifrs-full:EarningsBeforeInterestTaxesDepreciationAndAmortisation"],
    "eps_basic": ["us-gaap:EarningsPerShareBasic", "ifrs-full:BasicEarningsLossPerShare"],
    "eps_diluted": ["us-gaap:EarningsPerShareDiluted", "ifrs-full:DilutedEarningsLossPerShare"],
    "total_assets": ["us-gaap:Assets", "ifrs-full:Assets"],
    "assets_current": ["us-gaap:AssetsCurrent", "ifrs-full:CurrentAssets"],
    "total_liabilities": ["us-gaap:Liabilities", "ifrs-full:Liabilities"],
    "liabilities_current": ["us-gaap:LiabilitiesCurrent", "ifrs-full:CurrentLiabilities"],
    "equity": ["us-gaap:StockholdersEquity", "us-gaap:StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", "ifrs-full:Equity", "ifrs-full:NetAssetsLiabilities"],
    "cash": ["us-gaap:CashAndCashEquivalentsAtCarryingValue", "us-gaap:Cash", "ifrs-full:CashAndCashEquivalents"],
    "short_term_investments": ["us-gaap:ShortTermInvestments", "us-gaap:MarketableSecuritiesCurrent", "us-gaap:DebtSecuritiesHeldToMaturityAmortizedCostAfterAllowanceForCreditLossCurrent", "ifrs-full:CurrentFinancialAssets", "ifrs-full:OtherCurrentFinancialAssets"],
    "goodwill": ["us-gaap:Goodwill", "ifrs-full:Goodwill"],
    "accounts_receivable": ["us-gaap:AccountsReceivableNetCurrent", "ifrs-full:CurrentTradeReceivables", "ifrs-full:TradeAndOtherCurrentReceivables"],
    "accounts_payable": ["us-gaap:AccountsPayableCurrent", "ifrs-full:TradeAndOtherCurrentPayables"],
    "deferred_revenue": ["us-gaap:ContractWithCustomerLiabilityCurrent", "us-gaap:DeferredRevenueCurrent", "ifrs-full:CurrentContractLiabilities"],
    "retained_earnings": ["us-gaap:RetainedEarningsAccumulatedDeficit", "ifrs-full:RetainedEarnings"],
    "operating_cash_flow": ["us-gaap:NetCashProvidedByUsedInOperatingActivities", "ifrs-full:CashFlowsFromUsedInOperatingActivities"],
    "investing_cash_flow": ["us-gaap:NetCashProvidedByUsedInInvestingActivities", "ifrs-full:CashFlowsFromUsedInInvestingActivities"],
    "financing_cash_flow": ["us-gaap:NetCashProvidedByUsedInFinancingActivities", "ifrs-full:CashFlowsFromUsedInFinancingActivities"],
    "depreciation_and_amortization": ["us-gaap:DepreciationDepletionAndAmortization", "us-gaap:DepreciationAmortizationAndAccretionNet", "ifrs-full:DepreciationAmortisationAndImpairmentExpense"],
    "share_based_compensation": ["us-gaap:ShareBasedCompensation", "ifrs-full:SharebasedPaymentExpense"],
    "capex": ["us-gaap:PaymentsToAcquirePropertyPlantAndEquipment", "ifrs-full:PurchaseOfPropertyPlantAndEquipment"],
    "acquisitions": ["us-gaap:PaymentsToAcquireBusinessesNetOfCashAcquired", "ifrs-full:CashFlowsUsedInObtainingControlOfSubsidiariesOrOtherBusinesses"],
    "shares_outstanding": ["dei:EntityCommonStockSharesOutstanding", "us-gaap:CommonStockSharesOutstanding", "ifrs-full:NumberOfSharesOutstanding", "ifrs-full:NumberOfSharesIssued"],
    "weighted_avg_shares_basic": ["us-gaap:WeightedAverageNumberOfSharesOutstandingBasic", "ifrs-full:WeightedAverageNumberOfSharesOutstanding", "ifrs-full:WeightedAverageNumberOfOrdinarySharesOutstandingBasic", "ifrs-full:WeightedAverageShares"],
    "weighted_avg_shares_diluted": ["us-gaap:WeightedAverageNumberOfDilutedSharesOutstanding", "ifrs-full:WeightedAverageNumberOfSharesOutstandingDiluted", "ifrs-full:AdjustedWeightedAverageShares"],
}
#: Balances at a point in time; all others are amounts over a period.
INSTANT = {
    "total_assets", "assets_current", "total_liabilities", "liabilities_current", "equity", "cash", "short_term_investments",
    "goodwill", "accounts_receivable", "accounts_payable", "deferred_revenue", "retained_earnings", "shares_outstanding"
}
MOST_DAYS_OFF = 200


def attribute(attrs: Column, name: str) -> Column:
    """An attribute's value in a tag's text, else null."""
    return F.nullif(F.regexp_extract(attrs, rf"(?s)(?:^|\s){name}\s*=\s*['\"]([^'\"]*)['\"]", 1), F.lit(""))


def metric_tags(spark) -> DataFrame:
    """The dictionary as (metric, tag, tag_rank, instant), 102 rows."""
    rows = [(m, t, i, m in INSTANT) for m, tags in METRIC_TAGS.items() for i, t in enumerate(tags)]
    return spark.createDataFrame(rows, "metric string, name string, tag_rank int, instant boolean")


def contexts(filings: DataFrame) -> DataFrame:
    """(filing_id, context_ref, start, end, instant, segment_key) of the reporting contexts in ``raw``."""
    found = filings.select("filing_id", F.explode(F.regexp_extract_all("raw", F.lit(r"(?is)<xbrli:context\b[^>]*>.*?</xbrli:context>"), 0)).alias("x"))
    part = lambda tag: parse_date(clean_text(F.regexp_extract("x", rf"(?is)<(?:xbrli:)?{tag}>\s*([^<]+)\s*</(?:xbrli:)?{tag}>", 1)))
    members = F.filter(
        F.transform(
            F.regexp_extract_all("x", F.lit(r"(?is)<xbrldi:explicitMember\b[^>]*>(.*?)</xbrldi:explicitMember>"), 1), clean_text
        ),
        lambda m: m != ""
    )
    out = found.select(
        "filing_id", F.regexp_extract("x", r"(?is)^<xbrli:context\b[^>]*\bid=['\"]([^'\"]+)['\"]", 1).alias("context_ref"),
        part("startDate").alias("start"), part("endDate").alias("end"), part("instant").alias("instant_date"),
        F.nullif(F.array_join(members, "|"), F.lit("")).alias("segment_key")
    )
    return out.withColumns({"report_date": F.coalesce("instant_date", "end"), "days": F.date_diff("end", "start")})


def inline_facts(filings: DataFrame) -> DataFrame:
    """(filing_id, pos, name, value, context_ref, unit_ref) of inline facts: value times ten to the scale, and the sign."""
    tag = F.lit(r"(?is)<ix:(?:nonFraction|fraction)\b[^>]*>.*?</ix:(?:nonFraction|fraction)>")
    found = filings.select(
        "filing_id", F.posexplode(F.regexp_extract_all("raw", tag, 0)).alias("pos", "x")
    ).withColumn("attrs", F.regexp_extract("x", r"(?is)^<ix:\w+\b([^>]*)>", 1))
    value = parse_number(clean_text(F.regexp_extract("x", r"(?is)^<[^>]*>(.*)</ix:\w+>$", 1)))
    scale = F.coalesce(attribute(F.col("attrs"), "scale").try_cast("int"), F.lit(0))
    signed = value * F.pow(F.lit(10.0), scale) * F.when(attribute(F.col("attrs"), "sign") == "-", -1.0).otherwise(1.0)
    out = found.select(
        "filing_id", "pos", attribute(F.col("attrs"), "name").alias("name"), signed.alias("value"),
        attribute(F.col("attrs"), "contextRef").alias("context_ref"), attribute(F.col("attrs"), "unitRef").alias("unit_ref")
    )
    return out.where("name is not null and value is not null")


def tag_facts(filings: DataFrame, prefixes: str = "us-gaap|ifrs-full|dei") -> DataFrame:
    """Facts written as elements of their own; neither scale nor sign applies."""
    tag = F.lit(rf"(?is)<((?:{prefixes}):[A-Za-z0-9]+)\b[^>]*>.*?</\1>")
    found = filings.select(
        "filing_id", F.posexplode(F.regexp_extract_all("raw", tag, 0)).alias("pos", "x")
    ).withColumn("attrs", F.regexp_extract("x", r"(?is)^<[^\s>]+([^>]*)>", 1))
    out = found.select(
        "filing_id", (F.col("pos") + 1_000_000).alias("pos"), F.regexp_extract("x", r"^<([^\s>]+)", 1).alias("name"),
        parse_number(clean_text(F.regexp_extract("x", r"(?is)^<[^>]*>(.*)</[^>]*>$", 1))).alias("value"),
        attribute(F.col("attrs"), "contextRef").alias("context_ref"), attribute(F.col("attrs"), "unitRef").alias("unit_ref")
    )
    return out.where("value is not null")


def all_facts(filings: DataFrame) -> DataFrame:
    """Inline facts, all of them, and the tag facts that aren't among them."""
    return union_missing(inline_facts(filings), tag_facts(filings), ["filing_id", "name", "context_ref", "value"])


def chosen_metrics(filings: DataFrame, facts: DataFrame, ctx: DataFrame) -> DataFrame:
    """(filing_id, metric, value): the fact with the least (date gap, kind, duration gap, segment and tag rank, staleness).

    ``filings`` needs filing_id, form_type and target_end (a date or null).
    """
    tags = metric_tags(filings.sparkSession)
    rows = facts.join(tags, "name").join(filings.select("filing_id", "form_type", "target_end"), "filing_id").join(ctx, ["filing_id", "context_ref"], "left")
    gap = F.abs(F.date_diff("report_date", "target_end"))
    rows = rows.where(gap.isNull() | (gap <= MOST_DAYS_OFF))
    date = F.when(F.col("report_date").isNull(), 9999).otherwise(F.coalesce(gap, F.lit(0)))
    kind = F.when(
        F.when(F.col("instant"), F.col("instant_date").isNotNull()).otherwise(
            F.col("start").isNotNull() & F.col("end").isNotNull()
        ),
        0
    ).otherwise(200)
    span = F.when(F.col("instant"), 0).otherwise(F.coalesce(F.abs(F.col("days") - preferred_duration(F.col("form_type"))), F.lit(400)))
    segment = F.when(F.col("segment_key").isNull(), 0).when(F.col("segment_key").contains("|"), 25).otherwise(10)
    stale = F.when(F.col("target_end").isNull() & F.col("report_date").isNotNull(), -F.unix_date("report_date")).otherwise(0)
    rank = F.struct(
        date.alias("a"), kind.alias("b"), span.alias("c"), (segment + F.col("tag_rank")).alias("d"), stale.alias("e"),
        F.col("tag_rank").alias("f"), F.col("pos").alias("g"), F.col("value").alias("value")
    )
    return rows.groupBy("filing_id", "metric").agg(F.min(rank).alias("best")).select("filing_id", "metric", F.col("best.value").alias("value"))


def segment_total(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, value) of (*keys, segment_key, pos, value): the greatest value without a segment, else the sum of the last value of each segment."""
    parts = rows.groupBy(*keys, "segment_key").agg(F.max("value").alias("high"), F.max_by("value", "pos").alias("last"))
    whole, each = F.max(F.when(F.col("segment_key").isNull(), F.col("high"))), F.sum(F.when(F.col("segment_key").isNotNull(), F.col("last")))
    return parts.groupBy(*keys).agg(F.coalesce(whole, each).alias("value"))


def chosen_shares(filings: DataFrame, facts: DataFrame, ctx: DataFrame) -> DataFrame:
    """(filing_id, value): of the first tag with dated facts, on the date nearest the target (else the newest), the greatest unsegmented value, else the sum of the last value of each segment."""
    tags = metric_tags(filings.sparkSession).where("metric = 'shares_outstanding'")
    rows = facts.join(tags, "name").join(ctx, ["filing_id", "context_ref"]).where("report_date is not null").join(
        filings.select("filing_id", "target_end"), "filing_id"
    )
    dates = segment_total(rows, ["filing_id", "tag_rank", "report_date", "target_end"])
    order = F.struct("tag_rank", F.coalesce(F.abs(F.date_diff("report_date", "target_end")), -F.unix_date("report_date")).alias("gap"), "report_date", "value")
    return dates.groupBy("filing_id").agg(F.min(order).alias("best")).select("filing_id", F.col("best.value").alias("value"))


def report_columns(metrics: DataFrame) -> DataFrame:
    """One row for each filing with a column for each metric."""
    return metrics.groupBy("filing_id").agg(
        *(F.max(F.when(F.col("metric") == m, F.col("value"))).alias("ebitda" if m == "ebitda_direct" else m) for m in METRIC_TAGS)
    )
