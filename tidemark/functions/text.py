"""Text of filings: markup, labels, form types, sub-documents."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMS = ("10-K", "10-Q", "6-K", "20-F")
#: Markup entities of the plain SQL subset, with ``&amp;`` last.
ENTITIES = (
    ("&nbsp;", " "), ("&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&rsquo;", "’"),
    ("&mdash;", "—"), ("&ndash;", "–"), ("&amp;", "&")
)


def unescaped(text: Column) -> Column:
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def html_lines(raw: Column) -> Column:
    """The visible lines of a page: scripts and styles go, blocks end lines, tags become spaces."""
    t = F.regexp_replace(raw, "(?is)<script.*?>.*?</script>", " ")
    t = F.regexp_replace(t, "(?is)<style.*?>.*?</style>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(p|div|tr|li|h[1-6])\s*>", "\n")
    t = unescaped(F.regexp_replace(t, "(?s)<[^>]+>", " "))
    lines = F.transform(F.split(t, "\r\n|[\n\r\u000b\f\u001c-\u001e\u0085  ]"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    return F.filter(lines, lambda x: x != "")


def clean_text(raw: Column) -> Column:
    """Markup out without a trace, entities undone, white space squeezed."""
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(raw, "(?s)<[^>]+>", "")), r"\s+", " "))


def normal_label(label: Column) -> Column:
    """A row label for comparison: plain apostrophes, punctuation as spaces, squeezed, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.translate(label, "’—–-:,()", "'       "), r"\s+", " ")))


def sgml_documents(raw: Column) -> Column:
    """The sub-documents of a full submission as structs (pos, type, filename, description, text)."""
    bodies = F.regexp_extract_all(raw, F.lit("(?is)<DOCUMENT>(.*?)</DOCUMENT>"), 1)
    field = lambda b, tag: F.trim(F.regexp_extract(b, rf"(?i)<{tag}>([^\n<]*)", 1))
    return F.transform(
        bodies,
        lambda b, i: F.struct(
            i.alias("pos"), field(b, "TYPE").alias("type"), field(b, "FILENAME").alias("filename"),
            field(b, "DESCRIPTION").alias("description"), F.regexp_extract(b, "(?is)<TEXT>(.*?)(</TEXT>|$)", 1).alias("text")
        )
    )


#: Where a text says what form it is; what is meant stands in the first group.
FORM_PLACES = (
    r"(?is)<(ix:nonNumeric)\b[^>]*\bdei:DocumentType\b[^>]*>(.*?)</\1>", r"(?is)<(dei:DocumentType)\b[^>]*>(.*?)</\1>",
    r"(?i)(CONFORMED SUBMISSION TYPE):[ \t]*(\S+)", r"(?i)<(TYPE)>\s*([^\s<]+)"
)


def form_type(name: Column, raw: Column, annual_words: bool = False) -> Column:
    """The form from the file name, then from what the text says of itself; with ``annual_words`` an ``annual report`` is a 10-K."""
    upper = F.upper(name)
    stem = F.regexp_replace(upper, r"\.[^.]*$", "")
    by_name = F.coalesce(*(F.when(upper.contains(f"_{f}_") | stem.endswith(f), f) for f in FORMS))
    told = [F.upper(clean_text(F.regexp_extract(raw, p, 2))) for p in FORM_PLACES]
    worded = F.when(F.lit(annual_words) & F.upper(F.substring(raw, 1, 5000)).contains("ANNUAL REPORT"), "10-K")
    return F.coalesce(by_name, *(F.when(x.isin(*FORMS), x) for x in told), worded)


def path_ticker(path: Column) -> Column:
    """The ticker in a file's name, or else its folder if that looks like one."""
    name, folder = F.regexp_extract(path, "([^/]+)$", 1), F.regexp_extract(path, "([^/]+)/[^/]+$", 1)
    by_name = F.upper(F.regexp_extract(name, r"(?i)^([A-Z0-9.\-]+)_(?:10-K|10-Q|6-K|20-F)_", 1))
    return F.coalesce(F.nullif(by_name, F.lit("")), F.when(F.upper(folder).rlike(r"^[A-Z0-9.\-]{1,16}$"), F.upper(folder)))


def filing_date_text(name: Column, raw: Column) -> Column:
    """The filing date's text: header, acceptance time, file name."""
    parts = [
        F.regexp_extract(raw, r"(?i)FILED AS OF DATE:\s*(\d{8})", 1),
        F.regexp_extract(raw, r"(?i)ACCEPTANCE-DATETIME:\s*(\d{8})", 1), F.regexp_extract(name, r"_(\d{4}-\d{2}-\d{2})", 1)
    ]
    return F.coalesce(*(F.nullif(p, F.lit("")) for p in parts))


def depositary_first(label: Column) -> Column:
    """Whether a label counts in depositary shares: it names them, and before any ordinary shares."""
    n = normal_label(label)
    ads = F.regexp_instr(n, F.lit(r"american depositary share|depositary share|depository share|\b(?:ads|adss|adr|adrs)\b"))
    ordinary = F.regexp_instr(n, F.lit("ordinary share|common share"))
    return F.coalesce((ads > 0) & ((ordinary == 0) | (ads < ordinary)), F.lit(False))


def warrant_like(ticker: Column, text: Column) -> Column:
    """A warrant's ticker and the word within the first 50,000 characters."""
    return F.upper(ticker).rlike("(W|WS|WT|WTS)$") & F.lower(F.substring(text, 1, 50_000)).contains("warrant")


def tag_text(raw: Column, tag: str) -> Column:
    """The clean text of the first tagged fact of a name, inline or as an element of its own; else null."""
    inline = F.regexp_extract(raw, rf"(?is)<ix:nonNumeric\b[^>]*\bname=['\"]{tag}['\"][^>]*>(.*?)</ix:nonNumeric>", 1)
    element = F.regexp_extract(raw, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    return F.coalesce(*(F.nullif(clean_text(x), F.lit("")) for x in (inline, element)))


def company_name(raw: Column) -> Column:
    """The registrant's name: tagged, in the header, or the line above ``exact name of registrant``."""
    header = F.regexp_extract(raw, r"(?i)COMPANY CONFORMED NAME:[ \t]*([^\r\n]+)", 1)
    above = F.regexp_extract(F.array_join(F.slice(html_lines(raw), 1, 120), "\n"), r"(?i)([^\n]{2,100})\n\(?exact name of (?:the )?registrant", 1)
    return F.coalesce(tag_text(raw, "dei:EntityRegistrantName"), *(F.nullif(F.trim(x), F.lit("")) for x in (header, above)))


def analysis_text(documents: Column) -> Column:
    """The text to analyse of an array of sub-documents: press releases, else EX-99 exhibits, else all; null for none."""
    joined = lambda some: F.when(F.size(some) > 0, F.array_join(F.transform(some, lambda d: d["text"]), "\n"))
    kind = lambda d: F.regexp_replace(F.upper(d["type"]), "[^A-Z0-9]", "")
    release = F.filter(documents, lambda d: kind(d).startswith("EX99") & F.upper(d["description"]).rlike("PRESS RELEASE|EARNINGS RELEASE"))
    exhibits = F.filter(documents, lambda d: kind(d).startswith("EX99"))
    return F.coalesce(joined(release), joined(exhibits), joined(documents))


def plain_markup(raw: Column) -> Column:
    """A page as one line: tags become spaces, five entities are undone, white space is squeezed; blocks end no lines."""
    t = F.regexp_replace(F.regexp_replace(raw, "(?is)<script.*?</script>", " "), "(?is)<style.*?</style>", " ")
    t = F.regexp_replace(t, "(?s)<[^>]+>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def attributes(text: Column) -> Column:
    """A tag's attributes as a map, names in lower case; the last of equal names counts."""
    pairs = F.regexp_extract_all(text, F.lit(r"""([A-Za-z_:][\w:.\-]*\s*=\s*(?:'[^']*'|"[^"]*"))"""), 1)
    entry = lambda p: F.struct(F.lower(F.trim(F.substring_index(p, "=", 1))).alias("key"), F.regexp_extract(p, r"""(?s)=\s*['"](.*)['"]$""", 1).alias("value"))
    made = F.transform(pairs, entry)
    last = F.filter(made, lambda e, i: ~F.exists(F.slice(made, i + 2, F.greatest(F.size(made), F.lit(1))), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def wide_line(parts: list[tuple[Column, Column]], label: int = 10, value: int = 11) -> Column:
    """Pairs of a label and a value side by side, padded to fixed widths."""
    return F.concat(*(F.format_string(f"%-{label}s%{value}s", a, b) for a, b in parts))


@F.pandas_udf(T.StringType())
def _all_entities(text: pd.Series) -> pd.Series:
    return text.map(lambda x: x if x is None else html.unescape(x))


def every_entity(text: Column) -> Column:
    """All of HTML's character references undone, in Arrow batches; ``unescaped`` has the usual ones without Python."""
    return _all_entities(text)
