"""Derived figures of a report, in the order in which they build on one another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import safe_ratio

EXPENSES = ("cogs", "research_and_development", "selling_and_marketing", "general_and_administrative", "sga")
RATIOS = {
    "gross_margin": ("gross_profit", "revenue"), "operating_margin": ("operating_income", "revenue"),
    "net_margin": ("net_income", "revenue"), "ebitda_margin": ("ebitda", "revenue"), "return_on_equity": ("net_income", "equity"),
    "return_on_assets": ("net_income", "total_assets"), "current_ratio": ("assets_current", "liabilities_current"),
    "debt_to_equity": ("total_liabilities", "equity"), "asset_turnover": ("revenue", "total_assets")
}
NEEDED = sorted(
    {
        *EXPENSES, *(c for pair in RATIOS.values() for c in pair), "tax_expense", "pretax_income", "capex", "acquisitions",
        "depreciation_and_amortization", "free_cash_flow", "operating_cash_flow", "eps_basic", "eps_diluted",
        "weighted_avg_shares_basic", "weighted_avg_shares_diluted", "shares_outstanding"
    }
)


def derived(report: DataFrame) -> DataFrame:
    """Fill and repair a report's metrics and add its nine ratios; missing metric columns count as null."""
    c = F.col
    out = report.withColumns({m: F.lit(None).cast("double") for m in NEEDED if m not in report.columns})
    out = out.withColumns({m: F.abs(c(m)) for m in EXPENSES})
    some = c("selling_and_marketing").isNotNull() | c("general_and_administrative").isNotNull()
    out = out.withColumn(
        "sga",
        F.coalesce(
            "sga",
            F.when(some, F.coalesce("selling_and_marketing", F.lit(0.0)) + F.coalesce("general_and_administrative", F.lit(0.0)))
        )
    )
    odd = c("gross_profit").isNull() | (c("gross_profit") > c("revenue")) | (c("gross_profit") < -c("revenue"))
    out = out.withColumn("gross_profit", F.when(odd & c("revenue").isNotNull() & c("cogs").isNotNull(), c("revenue") - c("cogs")).otherwise(c("gross_profit")))
    flipped = F.abs(c("pretax_income") + c("tax_expense") - c("net_income")) + 1 < F.abs(c("pretax_income") - c("tax_expense") - c("net_income"))
    out = out.withColumns(
        {
            "tax_expense": F.when(flipped, -c("tax_expense")).otherwise(c("tax_expense")), "capex": -F.abs(c("capex")),
            "acquisitions": -F.abs(c("acquisitions"))
        }
    )
    made = c("operating_income") + c("depreciation_and_amortization")
    far = F.abs(c("ebitda") - made) / F.greatest(F.lit(1.0), F.abs(c("ebitda")), F.abs(made)) > 0.2
    out = out.withColumns(
        {
            "ebitda": F.when(made.isNotNull() & (c("ebitda").isNull() | far), made).otherwise(c("ebitda")),
            "free_cash_flow": F.coalesce("free_cash_flow", c("operating_cash_flow") + c("capex"))
        }
    )
    out = out.withColumns(
        {
            "eps_basic": F.coalesce("eps_basic", "eps_diluted"),
            "weighted_avg_shares_basic": F.coalesce("weighted_avg_shares_basic", "weighted_avg_shares_diluted")
        }
    )
    basic = c("weighted_avg_shares_basic")
    out = out.withColumns(
        {
            "weighted_avg_shares_diluted": F.when(
                c("weighted_avg_shares_diluted") < basic * 0.2, basic
            ).otherwise(c("weighted_avg_shares_diluted")),
            "shares_outstanding": F.coalesce("shares_outstanding", basic)
        }
    )
    off = (c("shares_outstanding") < basic * 0.2) | (c("shares_outstanding") > basic * 3.0)
    out = out.withColumns(
        {
            "shares_outstanding": F.when(off, basic).otherwise(c("shares_outstanding")),
            "equity": F.coalesce("equity", c("total_assets") - c("total_liabilities"))
        }
    )
    return out.withColumns({name: safe_ratio(c(a), c(b)) for name, (a, b) in RATIOS.items()})
