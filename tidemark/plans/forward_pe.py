"""Screen: profitable companies below a price-to-earnings limit that hold net cash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import half_even, present

PE_LIMIT = 20.0


def latest_eps(series: Column, kind: str) -> Column:
    """The latest 12-month value of a report type in an array of (asof, kind, period, value); dates compare as text."""
    some = F.filter(series, lambda e: (e["kind"] == kind) & (e["period"] == "12M") & e["value"].isNotNull())
    return F.array_max(F.transform(some, lambda e: F.struct(e["asof"].alias("date"), e["value"].alias("value"))))


def screened(df: DataFrame, limit: float = PE_LIMIT, digits: int | None = 2) -> DataFrame:
    """Add eps, forward P/E, status and reason.

    Needs price, fx_rate, market_cap_m, enterprise_value_m, pe_ttm and the
    structs projected and trailing (date, value), any of them null.  The limit
    holds for the P/E rounded to ``digits``, so that 19.996 isn't below 20; with
    None it stays as it is.
    """
    rounded = (lambda x: x) if digits is None else (lambda x: half_even(x, digits))
    use_p, use_t = F.coalesce(F.col("projected.value") > 0, F.lit(False)), F.coalesce(F.col("trailing.value") > 0, F.lit(False))
    eps = F.when(use_p, F.col("projected.value")).when(use_t, F.col("trailing.value"))
    priced = present(F.col("price"))
    by_eps, by_pe = priced & eps.isNotNull(), priced & F.coalesce(F.col("pe_ttm") > 0, F.lit(False))
    out = df.withColumns(
        {
            "eps_local": eps, "eps_date": F.when(use_p, F.col("projected.date")).when(use_t, F.col("trailing.date")),
            "eps_usd": F.when(by_eps, eps * F.col("fx_rate")), "net_cash_m": F.col("market_cap_m") - F.col("enterprise_value_m")
        }
    )
    pe = F.when(by_eps, rounded(F.col("price") / F.nullif("eps_usd", F.lit(0.0)))).when(by_pe, rounded(F.col("pe_ttm")))
    out = out.withColumns(
        {
            "forward_pe": pe,
            "eps_type": F.when(by_eps, F.when(use_p, "projection").otherwise("trailing")).when(by_pe, "vendor").otherwise(
                F.when(use_p, "projection").when(use_t, "trailing").otherwise("")
            ),
            "net_debt_m": -F.col("net_cash_m")
        }
    )
    low, cash = F.col("forward_pe") < limit, F.col("net_cash_m") > 0
    status = F.when(F.col("forward_pe").isNull() | F.col("net_cash_m").isNull(), "skipped").when(low & cash, "passed").otherwise("failed")
    why = F.concat_ws(
        "  ", F.when(~low, F.format_string(f"PE=%.1f>={limit:g}", "forward_pe")),
        F.when(~cash, F.format_string("net cash=%.0fM<=0", "net_cash_m"))
    )
    reason = F.when(F.col("forward_pe").isNull(), "no P/E").when(F.col("net_cash_m").isNull(), "no net cash").when(low & cash, F.col("eps_type")).otherwise(
        F.concat(why, F.lit("  ["), "eps_type", F.lit("]"))
    )
    return out.withColumns({"status": status, "reason": reason})


def summary(found: DataFrame) -> DataFrame:
    """One row: counts by class, mean forward P/E and median net cash of what passed."""
    ok = F.col("status") == "passed"
    return found.agg(
        F.count_if(ok).alias("passed"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status").isin("skipped", "error")).alias("skipped"),
        F.avg(F.when(ok, F.col("forward_pe"))).alias("mean_pe"),
        F.median(F.when(ok, F.col("net_cash_m"))).alias("median_net_cash")
    )
