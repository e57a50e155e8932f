"""Currencies, scales and depositary shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.dates import squeezed
from tidemark.functions.text import depositary_first

#: Currency names, tried in this order after a three-letter token.
CURRENCY_NAMES = (
    ("CNY", "RENMINBI|YUAN|人民币"), ("HKD", r"HONG\s*KONG"), ("TWD", r"NEW\s*TAIWAN"), ("JPY", "YEN"), ("KRW", "WON"),
    ("EUR", "EURO"), ("GBP", "POUND|STERLING"), ("BRL", "BRAZILIAN"), ("INR", "RUPEE"), ("USD", r"U\.?S\.?\s*DOLLAR|US\$")
)
SHARE_METRICS = ("shares_outstanding", "weighted_avg_shares_basic", "weighted_avg_shares_diluted")
EPS_METRICS = ("eps_basic", "eps_diluted")


def currency_code(unit: Column) -> Column:
    """The first free-standing three-letter word of a unit, else by name, else USD."""
    upper = F.upper(unit)
    token = F.regexp_extract(upper, r"(?U)\b[A-Z]{3}\b", 0)
    named = F.coalesce(*(F.when(upper.rlike(p), c) for c, p in CURRENCY_NAMES), F.lit("USD"))
    return F.when(unit.isNull() | (unit == ""), "USD").when(token.isin("RMB", "CNH"), "CNY").when(token != "", token).otherwise(named)


def unit_multiplier(unit: Column) -> Column:
    """Currency units to one unit of a filing: crore, thousand, million, billion, trillion."""
    u = F.upper(F.coalesce(unit, F.lit("")))
    return F.when(u.contains("CRORE"), 1e7).when(u.contains("THOUSAND"), 1e3).when(u.contains("MILLION"), 1e6).when(u.contains("BILLION"), 1e9).when(u.contains("TRILLION"), 1e12).otherwise(1.0)


def label_multiplier(label: Column) -> Column:
    t = F.lower(F.coalesce(squeezed(label), F.lit("")))
    return F.when(t.contains("billion"), 1e9).when(t.contains("million"), 1e6).when(t.contains("thousand"), 1e3).otherwise(1.0)


def composed_unit(currency: Column, label: Column) -> Column:
    """``CCY, label`` of what there is, else null."""
    none = F.lit("")
    return F.nullif(F.concat_ws(", ", F.nullif(F.upper(squeezed(currency)), none), F.nullif(squeezed(label), none)), none)


def per_depositary_share(metric: Column, label: Column, value: Column, ratio: Column) -> Column:
    """Share counts and per-share amounts in depositary shares; ``ratio`` is ordinary shares to each."""
    free = ratio.isNull() | (ratio == 0) | depositary_first(label)
    return F.when(free, value).when(
        metric.isin(*SHARE_METRICS), value / F.nullif(ratio, F.lit(0.0))
    ).when(metric.isin(*EPS_METRICS), value * ratio).otherwise(value)
