"""Which exhibit of a 6-K holds the results, and which the share data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import html_lines, sgml_documents
from tidemark.operators.ranking import best_by

#: Signals of periodic results, and scores by what an exhibit's start or description says.
QUARTER = (
    r"\bq[1-4]\b", r"\bfirst quarter\b", r"\bsecond quarter\b", r"\bthird quarter\b", r"\bfourth quarter\b", r"\bquarter ended\b",
    r"\bthree months ended\b", r"\binterim condensed consolidated financial statements\b", r"\breport to shareholders\b",
    r"\bselected share data\b", r"\bearnings release\b"
)
FINANCIAL = (
    r"\bbalance sheets?\b", r"\bstatements?\s+of\s+financial position\b",
    r"\bstatements?\s+of\s+(?:income|operations|cash flows?)\b", r"\bnet income\b", r"\bearnings per share\b",
    r"\btotal assets\b", r"\btotal liabilities\b", r"\bweighted average number of\b"
)
PRIMARY = (
    (20, r"\b(?:quarterly|interim|annual)\s+results\b"), (20, r"\binterim condensed consolidated financial statements\b"),
    (15, r"\bstatements?\s+of\s+(?:income|operations|financial position|cash flows?)\b"),
    (-50, r"\b(?:presentation|slide deck|webcast|conference call transcript)\b")
)
SHARE = (
    (80, r"\bselected share data\b"), (60, r"\bcommon shares outstanding\b"),
    (50, r"\bweighted average number of common shares\b"), (25, r"\bweighted average\b[^\n]{0,80}\bshares?\b"),
    (15, r"\bearnings per share\b"), (20, r"\breport to shareholders\b"),
    (15, r"\binterim condensed consolidated financial statements\b")
)
INCOME_WORDS = r"(?i)(total revenue|net revenue|net sales|gross profit|operating income|net income|net loss|earnings per share|loss per share|consolidated statements? of (operations|income|earnings|comprehensive))"
BALANCE_WORDS = r"(?i)(total assets|total liabilities|shareholders.{0,10}equity|stockholders.{0,10}equity|consolidated balance sheet|current assets|current liabilities)"


def has(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False))


def points(text: Column, rules: tuple[tuple[int, str], ...]) -> Column:
    """The sum of the points of all patterns that occur."""
    total = F.lit(0)
    for n, p in rules:
        total = total + F.when(has(text, p), n).otherwise(0)
    return total


def financial_text(text: Column) -> Column:
    """Five income words or three balance-sheet words within the first MiB."""
    head = F.substring(text, 1, 1 << 20)
    return (F.regexp_count(head, F.lit(INCOME_WORDS)) >= 5) | (F.regexp_count(head, F.lit(BALANCE_WORDS)) >= 3)


def financial_filing(documents: Column) -> Column:
    """Whether the main document of a filing is financial, or else its EX-99.1."""
    main = F.get(F.transform(documents, lambda d: d["text"]), 0)
    release = F.exists(documents, lambda d: F.regexp_replace(F.upper(d["type"]), "[^A-Z0-9]", "").isin("EX991", "991") & financial_text(d["text"]))
    return F.coalesce(financial_text(main), F.lit(False)) | F.coalesce(release, F.lit(False))


#: What banks' statements speak of, and how much of it makes a bank.
BANK_WORDS = (
    r"net interest income", r"loans and advances", r"customer deposits|deposits from customers", r"net interest margin",
    r"capital adequacy|cet ?1|tier 1", r"non-?performing loans?", r"provisions? for (?:credit|loan) losses"
)
BANK_LEAST = 3


def bank_like(text: Column, least: int = BANK_LEAST) -> Column:
    """Whether a text speaks of several things that only banks report."""
    return sum((has(text, p).cast("int") for p in BANK_WORDS), F.lit(0)) >= least


def long_enough(text: Column, least: int = 500) -> Column:
    """Whether an extracted document is long enough to be judged."""
    return F.coalesce(F.length(text) >= least, F.lit(False))


def scored_exhibits(filings: DataFrame) -> DataFrame:
    """All sub-documents of (filing_id, raw) with lines, kinds and both scores."""
    docs = filings.select("filing_id", F.inline(sgml_documents(F.col("raw")))).withColumn("lines", html_lines(F.col("text")))
    head = lambda n: F.array_join(F.slice("lines", 1, n), "\n")
    kind, name, about = F.regexp_replace(F.upper("type"), "[^A-Z0-9]", ""), F.upper("filename"), F.upper("description")
    quarter = sum((has(head(1200), p).cast("int") for p in QUARTER), F.lit(0))
    money = sum((has(head(1200), p).cast("int") for p in FINANCIAL), F.lit(0))
    dashed, news = name.contains("99-1") | name.contains("99_1"), about.contains("PRESS RELEASE") | about.contains("EARNINGS RELEASE")
    docs = docs.withColumns(
        {
            "periodic": (quarter >= 1) & (money >= 2),
            "machine": kind.isin(
                "XML", "JSON", "ZIP", "GRAPHIC", "EX101SCH"
            ) | name.rlike(r"\.(XML|JSON|XSD|ZIP|JPG|PNG|CSS|JS)$"),
            "release": kind.isin("EX991", "991") | dashed | news | has(head(400), r"\b(?:press|earnings)\s+release\b")
        }
    )
    by_kind = F.when(kind.isin("EX991", "991"), 50).when(kind.startswith("EX99"), 30).when(kind == "6K", 10).otherwise(0)
    slides = about.rlike("PRESENTATION|SLIDE|WEBCAST|TRANSCRIPT")
    n = F.size("lines")
    primary = by_kind + F.when(dashed, 35).otherwise(0) + F.when(news, 30).otherwise(0) + F.when(
        about.contains("REPORT TO SHAREHOLDERS"), 25
    ).otherwise(0) + points(head(1200), PRIMARY) - F.when(slides, 60).otherwise(0) + F.least(F.floor(n / 80), F.lit(10)) + F.when(F.col("periodic"), 25).otherwise(0)
    share = points(head(2500), SHARE) + F.least(F.floor(n / 120), F.lit(8)) + F.when(F.col("periodic"), 10).otherwise(0)
    return docs.withColumns({"n_lines": n, "primary_score": primary.cast("long"), "share_score": share.cast("long")})


def chosen_exhibits(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The primary exhibit and the share exhibit of each filing with periodic results; the first one wins ties."""
    some = scored.where("periodic")
    pool = F.when(F.col("machine"), 2).when(F.col("release"), 0).otherwise(1)
    first = best_by(some, ["filing_id"], [pool.asc(), F.col("primary_score").desc(), F.col("share_score").desc(), F.col("n_lines").desc(), F.col("pos").asc()])
    usable = F.when((F.col("share_score") > 0) & ~F.col("machine"), 0).otherwise(1)
    second = best_by(
        some, ["filing_id"],
        [usable.asc(), F.col("share_score").desc(), F.col("primary_score").desc(), F.col("n_lines").desc(), F.col("pos").asc()]
    )
    return first, second
