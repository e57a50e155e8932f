"""Numbers: accounting notation, safe ratios, rounding and human formats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a plain number looks like, so that casts don't accept suffixes such as ``1d``.
PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def as_double(text: Column) -> Column:
    """A double from a plain number, else null."""
    t = F.trim(text)
    return F.when(t.rlike(PLAIN), t.try_cast("double"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def parse_number(text: Column) -> Column:
    """A double from accounting notation: parentheses negate, commas and dollar signs go, K, M and B multiply.

    Blank, dashes and N/A are null, as is all that isn't a number then.
    """
    times = F.create_map(*(F.lit(x) for pair in (("K", 1e3), ("M", 1e6), ("B", 1e9)) for x in pair))

    def scaled(bare: Column) -> Column:
        stem = as_double(F.regexp_replace(bare, "[KkMmBb]$", ""))
        return stem * F.coalesce(F.try_element_at(times, F.upper(F.right(bare, F.lit(1)))), F.lit(1.0))

    def whole(t: Column) -> Column:
        inner = F.regexp_replace(t, r"(?s)^\((.*)\)$", "$1")
        bare = F.trim(F.regexp_replace(inner, r",|US\$|USD|\$", ""))
        signed = let(bare, scaled) * F.when(t.rlike(r"(?s)^\(.*\)$"), -1.0).otherwise(1.0)
        return F.when(~t.isin("", "-", "--", "---", "—", "N/A", "n/a"), signed)

    return let(F.trim(text), whole)


def safe_ratio(a: Column, b: Column) -> Column:
    """``a / b``; null if either is null or ``b`` is 0."""
    return a / F.nullif(b, F.lit(0.0))


def present(x: Column) -> Column:
    """Neither null nor 0."""
    return F.coalesce(x != 0, F.lit(False))


def half_even(x: Column, digits: int) -> Column:
    """Round the binary value itself, half to even, so that 2.675 gives 2.67.

    The product with the power of ten is taken without error: Dekker's split
    gives the part that the rounded product lost.
    """
    ten = float(10**digits)

    def of(v: Column) -> Column:
        high = v * 134217729.0 - (v * 134217729.0 - v)
        product = v * ten
        lost = (high * ten - product) + (v - high) * ten
        whole = F.floor(product).cast("double")
        part = product - whole
        up = (part > 0.5) | ((part == 0.5) & ((lost > 0) | ((lost == 0) & (F.pmod(whole, F.lit(2.0)) == 1))))
        return (whole + up.cast("double")) / ten

    return let(x, of)


def human(x: Column, signed: bool = True, billions: bool = True) -> Column:
    """Two decimals with K, M or B; without ``signed`` negative values stay unscaled, without ``billions`` M is the largest."""
    v = F.abs(x) if signed else x
    text = F.when(
        (v >= 1e9) & F.lit(billions), F.format_string("%.2fB", v / 1e9)
    ).when(
        v >= 1e6, F.format_string("%.2fM", v / 1e6)
    ).when(v >= 1e3, F.format_string("%.2fK", v / 1e3)).otherwise(F.format_string("%.2f", v))
    return F.concat(F.when(x < 0, "-").otherwise(""), text) if signed else text


def nearest_fraction(x: Column, most: int = 20) -> Column:
    """The nearest fraction with a denominator of at most ``most``; the smaller denominator on ties."""
    tries = F.transform(
        F.sequence(F.lit(1), F.lit(most)),
        lambda d: F.struct(F.abs(x - F.rint(x * d) / d).alias("gap"), d.alias("d"), (F.rint(x * d) / d).alias("value"))
    )
    return F.array_min(tries)["value"]


def canonical_ratio(x: Column) -> Column:
    """A depositary ratio as a simple fraction within 3 %, else rounded if between 0.05 and 50, else null."""
    f = nearest_fraction(x)
    return F.when(x > 0, F.when((f > 0) & (F.abs(x - f) / f <= 0.03), f).when(x.between(0.05, 50), F.round(x, 6)))


def digits_only(text: Column) -> Column:
    """A number of all digits and points of a text, negative in parentheses or after a minus sign; null without digits or with two points.

    The older table parser reads cells so: ``2024-Q1`` gives 20241.
    """

    def whole(t: Column) -> Column:
        kept = F.regexp_replace(t, r"[^0-9.]", "")
        signed = F.when(t.rlike(r"^\$?\(|^-"), -1.0).otherwise(1.0)
        return F.when(kept.rlike(r"\d") & (F.length(F.regexp_replace(kept, "[0-9]", "")) <= 1), kept.try_cast("double") * signed)

    return let(F.trim(text), whole)
