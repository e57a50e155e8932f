"""Statement lines as columns: titles, labels and figures of a line, units and columns that a header names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.dates import parse_date
from tidemark.functions.numbers import let
from tidemark.functions.statements import NOTE_MOST, NOTE_RULES, SIGNS, without_note
from tidemark.functions.text import normal_label

#: What opens a section, by kind, and what ends it besides the next title.
TITLES = {
    "income": r"(?i)\bstatements?\s+of\s+(?:\w+\s+)?(?:income|operations|earnings|comprehensive (?:income|loss)|profit (?:or|and) loss)\b|\bincome statements?\b",
    "balance": r"(?i)\bbalance sheets?\b|\bstatements?\s+of\s+financial position\b",
    "cash": r"(?i)\bstatements?\s+of\s+cash flows?\b|\bcash flow statements?\b",
}
LONGEST_TITLE = 200
STOP = r"(?i)^\s*(?:notes? to (?:the )?(?:condensed |unaudited |consolidated )*financial statements|the accompanying notes|see (?:accompanying )?notes|signatures?\b|about )"
#: Scales and currencies that a header names; the first that fits counts.
SCALE_WORDS = (
    (1e9, r"(?i)\bin\s+(?:\w+\s+){0,3}?billions?\b|\bbillions? of\b"), (1e6, r"(?i)\bin\s+(?:\w+\s+){0,3}?millions?\b|\bmillions? of\b|['’‘`]000,000\b"),
    (1e3, r"(?i)\bin\s+(?:\w+\s+){0,3}?thousands?\b|\bthousands? of\b|['’‘`]000\b")
)
CURRENCY_WORDS = (
    ("CNY", r"(?i)\brmb\b|renminbi|\bcny\b|人民币"), ("HKD", r"(?i)hk\$|\bhkd\b|hong kong dollars?"), ("TWD", r"(?i)nt\$|\bntd\b|\btwd\b|new taiwan dollars?"),
    ("CAD", r"(?i)c\$|\bcad\b|canadian dollars?"), ("JPY", r"(?i)¥|\bjpy\b|japanese yen|\byen\b"), ("EUR", r"(?i)€|\beuros?\b|\beur\b"),
    ("GBP", r"(?i)£|\bgbp\b|pounds? sterling"), ("INR", r"(?i)₹|\binr\b|indian rupees?"), ("BRL", r"(?i)r\$|\bbrl\b|brazilian reais"),
    ("USD", r"(?i)us\$|u\.s\. dollars?|\busd\b|us dollars?|\$")
)
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: Lines of a header that columns are read from, currencies of columns, most figures of one period.
HEADER_LINES, MOST_SUBCOLUMNS = 24, 4
COLUMN_CURRENCIES = {
    "KRW": "KRW", "USD": "USD", "US$": "USD", "CNY": "CNY", "RMB": "CNY", "HKD": "HKD", "HK$": "HKD", "BRL": "BRL", "R$": "BRL", "CAD": "CAD", "C$": "CAD",
    "EUR": "EUR", "GBP": "GBP", "JPY": "JPY"
}
PERIOD_CURRENCIES = ("rmb", "cny", "hkd", "hk$", "eur", "gbp", "jpy", "twd", "krw", "brl")

_MONTH = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_MONTHS = "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
DATE = rf"(?i)((?:(?:{_MONTH})[a-z]*\.?\s*(?:\d{{1,2}},?\s*)?)?(?:19|20)\d{{2}}\b)"
# A bare year in parentheses of its own is a negative figure.
_DATED = rf"(?i)\b(?:{_MONTH})[a-z]*\.?\s*(?:\d{{1,2}}\b,?\s*)?(?:(?:19|20)\d{{2}}\b)?|(?<!\()\b(?:19|20)\d{{2}}\b|\b(?:19|20)\d{{2}}\b(?!\))"
_DAY = rf"(?i)\b(?:{_MONTHS})\s+\d{{1,2}},\s+\d{{4}}\b"
_ANY_DAY = rf"{_DAY}|(?i:\b\d{{1,2}}-(?:{_MONTH})-\d{{2,4}}\b)"
_SIGN = "|".join(s.replace("$", r"\$") for s in SIGNS)
# Figures are taken whole, so that a long run of digits isn't tried in every way to part it.
_CELL = rf"(?>\(?+\s*+-?+\s*+(?:{_SIGN})?+\s*+\d[\d,]*+(?:\.\d++)?+\s*+\)?+\s*+%?+|(?<=\s)(?:-{{1,3}}+|[—–])(?=\s|$))"
_TAIL = rf"(?s)^(.*?)(?:[ \t$|)]*+{_CELL})*+[ \t$|)]*+$"
#: Labels that those of the rows below complete, and such rows.
PARENT = r"(?i):\s*$|^(?:net |basic |diluted )?(?:income|loss|earnings|weighted).*per (?:ordinary |common )?(?:share|ads)"
SUBROW = r"(?i)^(?:-+\s*)?(?:basic|diluted)\b"


def closed_parentheses(line: Column) -> Column:
    """``(12 )`` and ``( 12)`` without the space."""
    return F.regexp_replace(F.regexp_replace(line, r"(?<=\d)\s+\)", ")"), r"\(\s+(?=[\d$])", "(")


def title_kind(line: Column) -> Column:
    return F.coalesce(*(F.when(line.rlike(p), k) for k, p in TITLES.items()))


def line_head(line: Column) -> Column:
    """The part of a line before the figures and dashes that fill its end."""
    return F.regexp_extract(line, _TAIL, 1)


def line_label(head: Column) -> Column:
    return F.regexp_replace(head, r"[\s$|(]+$", "")


def line_tokens(line: Column, head: Column) -> Column:
    return F.regexp_extract_all(F.substr(line, F.length(head) + 1), F.lit(f"({_CELL})"), 1)


def token_figure(token: Column) -> Column:
    """A token's value; parentheses and a minus sign negate, a dash is null, as is a percentage."""
    digits = F.regexp_replace(token, r"[^\d.]", "")
    sign = F.when(token.contains("(") | token.rlike(r"-\s*\D*\d"), -1.0).otherwise(1.0)
    return F.when(~token.contains("%") & digits.rlike(r"\d"), digits.try_cast("double") * sign)


def only_dates(line: Column) -> Column:
    """Whether a line's figures are dates and parts of dates."""
    rest = F.regexp_replace(line, _DATED, " ")
    return line.rlike(_DATED) & (F.size(line_tokens(rest, line_head(rest))) == 0)


def header_currency(text: Column) -> Column:
    return F.coalesce(*(F.when(text.rlike(p), code) for code, p in CURRENCY_WORDS))


def header_scale(text: Column) -> Column:
    return F.coalesce(*(F.when(text.rlike(p), v) for v, p in SCALE_WORDS), F.lit(1.0))


def without_notes(values: Column) -> Column:
    """Values without up to three note numbers ahead of them, by ``NOTE_RULES``; nulls keep their places."""
    tenths = lambda v: F.abs(F.abs(v) * 10 - F.rint(F.abs(v) * 10)) < 1e-6
    note = lambda v: F.coalesce((F.abs(v) > 0) & (F.abs(v) <= NOTE_MOST) & tenths(v), F.lit(False))

    def drop(v: Column) -> Column:
        first, rest = F.get(v, 0), F.slice(v, 2, 100_000)
        later = F.filter(rest, lambda x: x.isNotNull())
        top, fits = F.array_max(F.transform(later, F.abs)), F.lit(False)
        for least, second, reach, times in NOTE_RULES:
            rule = (F.size(later) + 1 >= least) & (top >= F.greatest(F.lit(reach), F.abs(first) * times))
            fits = fits | (rule & note(F.get(v, 1)) if second else rule)
        return F.when(note(first) & F.coalesce(fits, F.lit(False)), rest).otherwise(v)

    return let(let(let(values, drop), drop), drop)


# --- which column is current -----------------------------------------------------------------------------


def newest_column(text: Column, columns: Column, quarter: Column) -> Column:
    """The column of the newest date, the first if several have it.

    Where a header holds quarters and longer periods and half the columns are
    quarters, a quarterly report takes the newest of those, any other of the rest.
    """
    year = lambda d: F.right(d, F.lit(4)).cast("int")
    month = lambda d: F.coalesce(*(F.when(F.lower(F.left(d, F.lit(3))) == m, k) for k, m in enumerate(MONTHS, 1)), F.lit(0))

    def of(dates: Column) -> Column:
        n = F.size(dates)
        some = F.when(n > columns, F.slice(dates, n - columns + 1, columns)).otherwise(dates)
        short, long = F.regexp_instr(text, F.lit("(?i)three months|quarter")), F.regexp_instr(text, F.lit("(?i)(?:six|nine|twelve) months|years? ended"))
        halves = (short > 0) & (long > 0) & (columns % 2 == 0) & (columns >= 4) & (F.size(some) == columns)
        half = F.expr("0") + (columns / 2).cast("int")
        first_half = F.when(halves, (short < long) == quarter)
        ranked = F.transform(some, lambda d, i: F.struct(year(d).alias("year"), month(d).alias("month"), (-i).alias("at")))
        inside = F.filter(ranked, lambda r: F.when(first_half.isNull(), -r["at"] < columns).otherwise((-r["at"] < half) == first_half))
        return F.when((n > 0) & (columns > 1), -F.array_max(inside)["at"]).otherwise(F.lit(0))

    return F.coalesce(let(F.regexp_extract_all(text, F.lit(DATE), 1), of), F.lit(0))


def currency_columns(header: Column) -> Column:
    """(local, usd): the first column in USD and the one before it, if there is one in another currency; else nulls.

    Currencies stand side by side in one line or one to a line; of both the
    longer list counts, lines that only say ``audited`` don't part it.
    """
    pattern = "(?i)(" + "|".join(x.replace("$", r"\$") for x in COLUMN_CURRENCIES) + ")"
    codes = F.create_map(*(F.lit(x) for p in COLUMN_CURRENCIES.items() for x in p))
    of_line = lambda line: F.transform(F.regexp_extract_all(line, F.lit(pattern), 1), lambda t: F.try_element_at(codes, F.upper(t)))
    state = "struct<stack:array<string>,longest:array<string>,widest:array<string>>"
    empty = F.array().cast("array<string>")
    zero = F.struct(empty.alias("stack"), empty.alias("longest"), empty.alias("widest")).cast(state)
    longer = lambda a, b: F.when(F.size(a) > F.size(b), a).otherwise(b)

    def step(s: Column, line: Column) -> Column:
        tokens = of_line(line)
        passed = (F.size(tokens) == 0) & (F.size(s["stack"]) > 0) & F.lower(line).contains("audited")
        stack = F.when(F.size(tokens) == 1, F.concat(s["stack"], tokens)).when(passed, s["stack"]).otherwise(empty)
        return F.struct(stack.alias("stack"), longer(stack, s["longest"]).alias("longest"), longer(tokens, s["widest"]).alias("widest"))

    best = F.aggregate(F.slice(header, 1, HEADER_LINES), zero, step, lambda s: longer(s["longest"], s["widest"]))
    usd = F.array_position(best, "USD").cast("int") - 1
    return let(usd, lambda at: F.struct(F.when(at > 0, at - 1).alias("local"), F.when(at > 0, at).alias("usd")))


def dated_column(header: Column) -> Column:
    """The column of the current period by the days or years that a header counts off; null where it can't tell.

    Three and nine months with four days in order: the last.  A quarter and a
    year with four or six years: the last of the newest.  Otherwise, of four
    days or more, the last of the newest if it repeats; of five days the
    third, of four the second.
    """
    text = F.array_join(F.slice(header, 1, HEADER_LINES), " ")
    low = normal_label(text)
    three, nine = low.contains("three months ended"), low.contains("nine months ended")
    quarter_and_year = low.rlike(r"\b(?:three months ended|quarter ended)\b") & low.rlike(r"\byear ended\b")
    days = lambda pattern: F.filter(F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), 1), parse_date), lambda d: d.isNotNull())
    years = F.transform(F.regexp_extract_all(text, F.lit(r"\b(20\d{2})\b"), 1), lambda y: y.cast("int"))
    last_of = lambda some: F.size(some) - F.array_position(F.reverse(some), F.array_max(some)).cast("int")

    def by_days(d: Column) -> Column:
        again = F.size(F.filter(d, lambda x: x == F.array_max(d))) > 1
        return F.when(F.size(d) < 4, F.lit(None)).when(again, last_of(d)).when(F.size(d) == 5, 2).when(F.size(d) == 4, 1)

    run = let(days(_DAY), lambda d: (F.size(d) == 4) & (d == F.array_sort(d)))
    by_years = let(years, lambda y: F.when(F.size(y).isin(4, 6), last_of(y)))
    return F.when(three & nine & run, 3).when(~(three & nine) & quarter_and_year, by_years).otherwise(let(days(_ANY_DAY), by_days))


def resolved_columns(by_currency: Column, by_date: Column) -> Column:
    """(local, usd) of both: a date's column moves the currency's if it isn't before them, and stands in where they are missing."""
    local, usd = by_currency["local"], by_currency["usd"]
    move = F.when(by_date >= usd, by_date - usd).otherwise(0)
    return F.struct(F.coalesce(local + F.coalesce(move, F.lit(0)), by_date).alias("local"), F.coalesce(usd + F.coalesce(move, F.lit(0)), by_date).alias("usd"))


def period_flags(header: Column) -> Column:
    """For each day that a header counts off, whether its column is in USD, if a currency stands with it or after it."""
    state = "struct<waits:boolean,flags:array<boolean>>"
    zero = F.struct(F.lit(False).alias("waits"), F.array().alias("flags")).cast(state)

    def step(s: Column, line: Column) -> Column:
        low = normal_label(line)
        usd = low.contains("usd") | low.contains("us$")
        known = usd
        for code in PERIOD_CURRENCIES:
            known = known | low.contains(code)
        dated = line.rlike(_DAY)
        takes = known & (dated | s["waits"])
        waits = F.when(low == "", s["waits"]).when(takes, F.lit(False)).otherwise(dated | s["waits"])
        return F.struct(waits.alias("waits"), F.when(takes, F.concat(s["flags"], F.array(usd))).otherwise(s["flags"]).alias("flags"))

    return F.aggregate(F.slice(header, 1, HEADER_LINES), zero, step, lambda s: F.when(s["waits"], F.concat(s["flags"], F.array(F.lit(False)))).otherwise(s["flags"]))


def repeated_columns(flags: Column, sizes: Column) -> Column:
    """(local, usd) where each period has several figures: the last figure of the last period in each currency, else nulls.

    ``sizes`` are the rows' numbers of figures; the most frequent that parts
    evenly into the periods counts, the larger on ties.
    """

    def of(x: Column) -> Column:
        n = F.size(x["flags"])
        fits = F.filter(x["sizes"], lambda s: (s >= 2 * n) & (s % n == 0) & (s / n <= MOST_SUBCOLUMNS))
        counted = F.transform(F.array_distinct(fits), lambda s: F.struct(F.size(F.filter(fits, lambda t: t == s)).alias("n"), s.alias("s")))
        each = (F.array_max(counted)["s"] / n).cast("int")
        last = lambda usd: n - F.array_position(F.reverse(x["flags"]), F.lit(usd)).cast("int")
        place = lambda usd: F.when((n > 1) & F.array_contains(x["flags"], usd), last(usd) * each + each - 1)
        return F.struct(place(False).alias("local"), place(True).alias("usd"))

    return let(F.struct(flags.alias("flags"), sizes.alias("sizes")), of)


def mixed_value(values: Column, usd: Column, quarter: Column) -> Column:
    """The current value among quarters and years, by how many there are; null for fewer than four.

    A seventh value up to 99 that is whole numbers a note and doesn't count.
    """

    def of(v: Column) -> Column:
        tail = F.get(v, F.size(v) - 1)
        some = F.when((F.size(v) == 7) & (tail == F.rint(tail)) & (F.abs(tail) > 0) & (F.abs(tail) <= NOTE_MOST), F.slice(v, 1, 6)).otherwise(v)
        at = lambda x: F.when(F.size(x) >= 7, F.when(usd, 3).otherwise(2)).when(
            F.size(x) == 6, F.when(quarter, F.when(usd, 1).otherwise(0)).otherwise(F.when(usd, 5).otherwise(4))
        ).when(F.size(x) == 5, F.when(quarter, 0).otherwise(4)).when(F.size(x) == 4, F.when(quarter, 0).otherwise(2))
        return let(some, lambda x: F.get(x, at(x)))

    return let(without_note(values), of)
