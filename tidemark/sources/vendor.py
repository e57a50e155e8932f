"""Vendor fundamentals in XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import as_double
from tidemark.plans.forward_pe import latest_eps

SUMMARY = "EPSs struct<_currency:string,EPS:array<struct<_VALUE:string,_asofDate:string,_reportType:string,_period:string>>>"
SNAPSHOT = "Ratios struct<_ExchangeRate:string,_ReportingCurrency:string,_PriceCurrency:string,Group:array<struct<_ID:string,Ratio:array<struct<_VALUE:string,_FieldName:string>>>>>"


def eps_columns(xml: Column) -> dict[str, Column]:
    """eps_currency, projected and trailing (date, value) of a summary; too short or malformed XML gives nulls."""
    x = F.from_xml(F.when(F.length(xml) >= 50, xml), SUMMARY)
    series = F.transform(
        x["EPSs"]["EPS"],
        lambda e: F.struct(
            F.coalesce(e["_asofDate"], F.lit("")).alias("asof"), e["_reportType"].alias("kind"), e["_period"].alias("period"),
            as_double(e["_VALUE"]).alias("value")
        )
    )
    return {
        "eps_currency": F.coalesce(x["EPSs"]["_currency"], F.when(x["EPSs"].isNotNull(), "USD")),
        "projected": latest_eps(series, "P"), "trailing": latest_eps(series, "TTM")
    }


def snapshot_columns(xml: Column) -> dict[str, Column]:
    """fx_rate, reporting_currency, price, market_cap_m, enterprise_value_m and pe_ttm; -1 and -99999.99 stand for nothing."""
    x = F.from_xml(F.when(F.length(xml) >= 50, xml), SNAPSHOT)["Ratios"]
    ratios = F.flatten(F.transform(x["Group"], lambda g: F.coalesce(g["Ratio"], F.array().cast("array<struct<_VALUE:string,_FieldName:string>>"))))

    def field(name: str) -> Column:
        v = as_double(F.get(F.filter(ratios, lambda r: r["_FieldName"] == name), 0)["_VALUE"])
        return F.when(~v.isin(-1.0, -99999.99), v)

    return {
        "fx_rate": F.coalesce(as_double(x["_ExchangeRate"]), F.lit(1.0)),
        "reporting_currency": F.coalesce(x["_ReportingCurrency"], F.lit("USD")), "price": field("NPRICE"),
        "market_cap_m": field("MKTCAP"), "enterprise_value_m": field("EV"), "pe_ttm": field("PEEXCLXOR")
    }


def cached(cache: DataFrame, as_of: Column, ttl_days: int = 45) -> DataFrame:
    """Cached reports that may still be served: no older than the time to live, to the second."""
    return cache.where(F.col("fetched_at").cast("timestamp") >= as_of - F.make_dt_interval(F.lit(ttl_days)))


def cache_stats(cache: DataFrame, as_of: Column, ttl_days: int = 45, keys: tuple[str, ...] = ()) -> DataFrame:
    """total, fresh and expired, for each of the keys; one exactly as old as the time to live counts as expired."""
    fresh = F.count_if(F.col("fetched_at").cast("timestamp") > as_of - F.make_dt_interval(F.lit(ttl_days)))
    return cache.groupBy(*keys).agg(F.count("*").alias("total"), fresh.alias("fresh"), (F.count("*") - fresh).alias("expired"))
