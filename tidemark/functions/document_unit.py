"""A filing's currency and scale: everything in it that tells them, as ranked evidence.

Places that name both together come first, in this order: the reporting
currency where it isn't the dollar, the lines below titles of statements,
sentences on amounts in the head, and names before scales there.  Failing
those, the currency and the scale come from evidence of their own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import let
from tidemark.functions.text import normal_label
from tidemark.session import once

#: Names of currencies, in the order in which equally good places count.
NAMES = {
    "CAD": r"canadian dollars?|cad|c\$", "BRL": r"brazilian reais?|brazilian real|reais|brl|r\$", "CNY": "renminbi|rmb|cny",
    "HKD": r"hong kong dollars?|hkd|hk\$", "EUR": "euros?|eur|€", "GBP": "pounds? sterling|gbp", "JPY": "yen|jpy", "KRW": "korean won|krw",
    "TWD": r"new taiwan dollars?|nt\$|twd", "USD": r"u\.?s\.?\s*dollars?|usd|us\$", "INR": "indian rupees?|inr|₹"
}
#: Words that stand alone in the heads of columns.
COLUMN_WORDS = {
    "cad": "CAD", "c$": "CAD", "brl": "BRL", "r$": "BRL", "reais": "BRL", "rmb": "CNY", "cny": "CNY", "renminbi": "CNY", "hkd": "HKD", "hk$": "HKD", "eur": "EUR",
    "gbp": "GBP", "jpy": "JPY", "krw": "KRW", "twd": "TWD", "nt$": "TWD", "usd": "USD", "us$": "USD"
}
SCALES = ("thousands", "millions", "billions")
#: Lines that are searched for the reporting currency, for sentences, for names; lines below a title, titles that count.
REPORTING_LINES, HEAD_LINES, LEAD_LINES, TITLE_LINES, WINDOW, COLUMN_TITLES, COLUMN_LINES, SCALE_TITLES = 4000, 1200, 240, 1500, 12, 12, 28, 40
PLACES = ("reporting", "title", "title_words", "sentence", "name_first", "apart")
STATEMENT = (
    r"(?i)balance sheets?|statements?\s+of\s+(?:operations|income|cash flows|financial position|profit or loss|comprehensive income|comprehensive loss)"
    r"|(?:operations|income|cash flows|profit or loss|comprehensive income|comprehensive loss)\s+statements?"
)
ANY_TITLE = r"(?i)balance sheets?|statements?\s+of|statement\s+s?\s+of|financial position|cash flows?"
_ANY = "|".join(NAMES.values())
_EDGE = r"(?=\W|$)"
MONEY = rf"(?i)amounts?|\byen\b|{_ANY}"


def _code(name: Column) -> Column:
    """The currency of a name; null for no name."""
    return let(name, lambda x: F.coalesce(*(F.when(x.rlike(rf"(?i)^(?:{p})$"), c) for c, p in NAMES.items())))


def _rank(code: Column, scale: Column) -> Column:
    return F.array_position(F.lit(list(NAMES)), code) * 10 + F.array_position(F.lit(list(SCALES)), scale)


def _told(text: Column, pattern: str, currency: int, scale: int) -> Column:
    """(rank, currency, scale) of the first match of a pattern with groups for both."""
    code, size = _code(F.regexp_extract(text, pattern, currency)), F.lower(F.regexp_extract(text, pattern, scale))
    ranked = lambda x: F.when(x["code"].isNotNull() & (x["size"] != ""), F.struct(_rank(x["code"], x["size"]).alias("rank"), x["code"].alias("currency"), x["size"].alias("scale")))
    return let(F.when(text.rlike(pattern), F.struct(code.alias("code"), size.alias("size"))), ranked)


def _first(some: Column) -> Column:
    return F.get(F.filter(some, lambda x: x.isNotNull()), 0)


def _at(lines: Column, where: Column, n: int, most: int) -> Column:
    """The places of the first ``most`` lines, of the first ``n``, for which the flags ``where`` hold."""
    marked = F.transform(F.slice(lines, 1, n), lambda x, i: F.when(where(x), i))
    return F.slice(F.filter(marked, lambda i: i.isNotNull()), 1, most)


def _window(lines: Column, at: Column, n: int | Column) -> Column:
    return F.array_join(F.slice(lines, at + 1, n), " ")


_SIZE = "(thousands|millions|billions)"
_DOLLARS = r"(?:u\.?s\.?\s*)?dollars?"
#: Currency and scale side by side, below titles: the currency's name first, or the scale.
TITLE_FORMS = (
    (rf"(?i)\bin\s+({_ANY})\s+{_SIZE}\b", 1, 2), (rf"(?i)\bin\s+{_SIZE}\s+of\s+({_ANY}){_EDGE}", 2, 1),
    (rf"(?i)\b({_ANY})\s+in\s+{_SIZE}\b", 1, 2), (rf"(?i)\b({_ANY})\s*\(\s*{_SIZE}\s*\)", 1, 2)
)
TITLE_DOLLARS = (rf"(?i)\bin\s+{_DOLLARS}\s+{_SIZE}\b", rf"(?i)\b{_DOLLARS}\s+in\s+{_SIZE}\b", rf"(?i)\bin\s+{_SIZE}\s+of\s+{_DOLLARS}\b")


def title_unit(lines: Column) -> tuple[Column, Column]:
    """What the twelve lines from a statement's title on say: currency and scale side by side, and a scale with the first currency near it."""
    titles = _at(lines, lambda x: F.coalesce(x.rlike(STATEMENT), F.lit(False)), 1_000_000, 1_000_000)
    windows = F.transform(titles, lambda i: _window(lines, i, WINDOW))
    sized, money = rf"(?i)\bin\s+{_SIZE}\b", rf"(?i)(?<![a-z])({_ANY}){_EDGE}"

    def sides(text: Column) -> Column:
        dollar = lambda p: F.when(text.rlike(p), F.struct(F.lit(0).cast("long").alias("rank"), F.lit("USD").alias("currency"), F.lower(F.regexp_extract(text, p, 1)).alias("scale")))
        return _first(F.array(*map(dollar, TITLE_DOLLARS), *(_told(text, p, a, b) for p, a, b in TITLE_FORMS)))

    def near(i: Column) -> Column:
        def both(text: Column) -> Column:
            size = F.coalesce(*(F.when(text.rlike(rf"(?i)\bin\s+{s}\b"), s) for s in SCALES))
            code = _code(F.regexp_extract(text, money, 1))
            return F.when(text.rlike(sized) & text.rlike(money), F.struct(F.lit(0).cast("long").alias("rank"), code.alias("currency"), size.alias("scale")))

        return _first(F.transform(F.transform(F.sequence(F.lit(1), F.lit(WINDOW)), lambda n: _window(lines, i, n)), both))

    return _first(F.transform(windows, sides)), _first(F.transform(titles, near))  # the titles' first, in the order of lines


def sentence_unit(lines: Column) -> tuple[Column, Column]:
    """What up to three lines in the head say: ``amounts in thousands of ... dollars``, and ``in dollars thousands``; the best of all such places."""
    some = _at(lines, lambda x: F.coalesce(x.rlike(r"(?i)amounts?|\bin\b"), F.lit(False)), HEAD_LINES, HEAD_LINES)
    texts = F.transform(some, lambda i: _window(lines, i, 3))
    windows = lambda p, a, b: F.array_min(F.transform(F.filter(texts, lambda x: x.rlike(p)), lambda x: _told(x, p, a, b)))
    amounts = rf"(?i)amounts?\s+in\s+{_SIZE}\s+of\s+[^()\n]{{0,80}}?({_ANY}){_EDGE}"
    return windows(amounts, 2, 1), windows(rf"(?i)\bin\s+({_ANY})\s+{_SIZE}\b", 1, 2)


def column_currency(lines: Column) -> Column:
    """The currency that most often stands alone on a line below titles; another than the dollar on ties, then the greater code."""
    titles = _at(lines, lambda x: F.coalesce(x.rlike(rf"{ANY_TITLE}|income"), F.lit(False)), TITLE_LINES, COLUMN_TITLES)
    codes = F.create_map(*(F.lit(x) for p in COLUMN_WORDS.items() for x in p))
    words = F.flatten(F.transform(titles, lambda i: F.transform(F.slice(lines, i + 1, COLUMN_LINES), lambda x: F.try_element_at(codes, normal_label(x)))))

    def most(found: Column) -> Column:
        count = lambda c: F.struct(F.size(F.filter(found, lambda x: x == c)).alias("n"), (c != "USD").alias("other"), c.alias("code"))
        return F.array_max(F.transform(F.array_distinct(found), count))["code"]

    return let(F.filter(words, lambda x: x.isNotNull()), most)


def context_scale(lines: Column) -> Column:
    """The scale that stands with titles of statements, or in the head if there are none; alone, with signs and zeros, or with money."""
    titles = _at(lines, lambda x: F.coalesce(x.rlike(ANY_TITLE), F.lit(False)), TITLE_LINES, SCALE_TITLES)
    pairs = lambda i: F.array(F.get(lines, i), _window(lines, i, 2))
    below = F.flatten(F.flatten(F.transform(titles, lambda i: F.transform(F.sequence(i, F.least(i + WINDOW - 1, F.size(lines) - 1)), pairs))))
    lead = F.transform(F.slice(lines, 1, LEAD_LINES), lambda x, i: _window(lines, i, 2))
    direct = rf"(?i)(?:^|\()\s*in\s+{_SIZE}\b"

    def of(w: Column) -> Column:
        stated = lambda some: F.lower(F.regexp_extract(F.get(some, 0), direct, 1))
        plain = F.filter(w["some"], lambda x: x.rlike(direct) & (w["titled"] | x.rlike(ANY_TITLE) | x.rlike(MONEY)))
        return F.when(F.size(plain) > 0, stated(plain))

    def zeros(some: Column, n: int) -> Column:
        pattern = rf"(?i)(?<![a-z])(?:{_ANY})\s*['’]?\s*0{{{n}}}\b"
        return F.exists(some, lambda x: x.rlike(pattern))

    def worded(some: Column, scale: str) -> Column:
        return F.exists(some, lambda x: x.rlike(rf"(?i)\bin {scale}\b") & x.rlike(MONEY))

    def whole(w: Column) -> Column:
        signs = [F.when(zeros(w["some"], n), s) for s, n in (("billions", 9), ("millions", 6), ("thousands", 3))]
        words = [F.when(worded(w["some"], s), s) for s in SCALES]
        return F.coalesce(of(w), *signs, *words)

    titled = F.size(titles) > 0
    return let(F.struct(titled.alias("titled"), F.when(titled, below).otherwise(lead).alias("some")), whole)


def _mode(values: Column) -> Column:
    """The most frequent value, the greatest on ties."""
    return let(values, lambda v: F.array_max(F.transform(F.array_distinct(v), lambda x: F.struct(F.size(F.filter(v, lambda y: y == x)).alias("n"), x.alias("x"))))["x"])


def inline_scale(raw: Column) -> Column:
    """The scale that most inline facts have."""
    powers = F.regexp_extract_all(raw, F.lit(r"""(?i)<ix:nonFraction\b[^>]*\bscale=["'](\d+)["']"""), 1)
    known = F.create_map(*(F.lit(x) for p in (("3", "thousands"), ("6", "millions"), ("9", "billions")) for x in p))
    return F.try_element_at(known, _mode(powers))


@once
def unit_evidence(raw: str, lines: str) -> Column:
    """Every place that tells a filing's unit: structs (tier, currency, scale), the best first, ``scale`` null where it isn't told.

    Tiers are those of ``PLACES``.  The last takes the currency from columns of
    statements, tagged units, the reporting currency or names in the first
    lines, a dollar sign at worst, and the scale from the words around titles
    or tagged facts.  ``raw`` and ``lines`` name columns.
    """
    raw, lines = F.col(raw), F.col(lines)
    text = F.array_join(F.slice(lines, 1, REPORTING_LINES), "\n")
    reporting = F.coalesce(*(F.when(text.rlike(rf"(?i)\bour\s+reporting\s+currency\s+is\s+(?:the\s+)?(?:{p}){_EDGE}"), c) for c, p in NAMES.items()))
    lead = F.array_join(F.slice(lines, 1, LEAD_LINES), "\n")
    named = F.coalesce(*(F.when(lead.rlike(rf"(?i)(?<![a-z])(?:{p})(?=\W|\d|$)"), c) for c, p in NAMES.items() if c != "INR"))
    tagged = _mode(F.transform(F.regexp_extract_all(raw, F.lit(r"(?i)<xbrli:measure>\s*iso4217:([A-Z]{3})\s*</xbrli:measure>"), 1), F.upper))
    sign = lambda n: F.array_join(F.slice(lines, 1, n), "\n").contains("$") & ~F.array_join(F.slice(lines, 1, n), "\n").rlike(r"(?i)(?:c|hk|r)\$")
    scale = F.coalesce(context_scale(lines), inline_scale(raw))

    def apart(s: Column) -> Column:
        base, column = F.coalesce(s["reporting"], named), s["column"]
        code = F.when(column.isNotNull() & (base.isNull() | (column != "USD")), column).otherwise(F.coalesce(F.when(column.isNull(), tagged), base))
        code = F.coalesce(code, F.when(sign(LEAD_LINES) | (s["scale"].isNotNull() & sign(HEAD_LINES)), "USD"))
        return F.struct(code.alias("currency"), s["scale"].alias("scale"))

    def of(s: Column) -> Column:
        side, near = title_unit(lines)
        said, named_first = sentence_unit(lines)
        told = F.struct(F.when(s["reporting"] != "USD", s["reporting"]).alias("currency"), F.lit(None).cast("string").alias("scale"))
        found = (told, side, near, said, named_first, apart(s))
        every = [F.struct(F.lit(k).alias("tier"), x["currency"].alias("currency"), x["scale"].alias("scale")) for k, x in enumerate(found)]
        return F.filter(F.array(*every), lambda e: e["currency"].isNotNull())

    return let(F.struct(reporting.alias("reporting"), column_currency(lines).alias("column"), scale.alias("scale")), of)


def document_unit(evidence: Column) -> Column:
    """``CNY, thousands``, the currency alone, or null: the best of ``unit_evidence``."""
    best = F.get(evidence, 0)
    return F.nullif(F.concat_ws(", ", best["currency"], best["scale"]), F.lit(""))
