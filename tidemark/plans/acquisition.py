"""Which filing to take for each company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import newer_of
from tidemark.operators.ranking import best_by

DONE = ("ok", "exists", "skip")
FOREIGN = ("20-F", "6-K", "40-F")


def foreign(forms: Column) -> Column:
    """Whether any form is one that foreign issuers file."""
    return F.exists(forms, lambda f: F.upper(f).isin(*FOREIGN))


def pending(tickers: DataFrame, progress: DataFrame) -> DataFrame:
    """Tickers that aren't done."""
    return tickers.join(progress.where(F.col("status").isin(*DONE)), "ticker", "left_anti")


def latest_of_forms(submissions: DataFrame, forms: tuple[str, ...], key: str = "path") -> DataFrame:
    """The newest filing among ``forms``: for each form the first of its newest date, then the newest of all, listed order of forms on ties."""
    rank = F.array_position(F.lit(list(forms)), F.upper("form"))
    return best_by(submissions.where(rank > 0), [key], [F.col("filed").desc(), rank.asc(), F.col("pos").asc()])


def newest_6k(index: DataFrame, most: int = 20) -> DataFrame:
    """The ``most`` newest 6-K filings of each company, with accession numbers in dashed form and their place.

    Filings of a day stand in the order of their numbers: the shorter path
    first, as numbers that outgrow their ten or six digits are longer.
    """
    some = index.where(F.upper("form") == "6-K").withColumn("accession", F.regexp_extract("path", r"([0-9]{10,}-[0-9]{2}-[0-9]{6,})", 1))
    return best_by(some, ["cik"], [F.col("filed").desc(), F.length("path").asc(), F.col("path").asc()], most)


def keyword_hits(text: Column, words: tuple[str, ...]) -> Column:
    """How many of the words occur in the first MiB, case ignored."""
    low = F.lower(F.substring(text, 1, 1 << 20))
    total = F.lit(0)
    for w in words:
        total = total + low.contains(w).cast("int")
    return total


def six_k_or_annual(six_k: DataFrame, annual: DataFrame) -> DataFrame:
    """The newer of a company's financial 6-K and its 20-F; the 6-K on ties."""
    return newer_of(six_k, annual, "cik", "filed")


def filing_url(cik: Column, accession: Column, document: Column) -> Column:
    return F.concat(
        F.lit("https://www.sec.gov/Archives/edgar/data/"), F.regexp_replace(cik, "^0+", ""), F.lit("/"),
        F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), document
    )


def with_cik(tickers: DataFrame, known: DataFrame) -> DataFrame:
    """Tickers with their cik, null where there is none; ``known`` has one row for each ticker."""
    return tickers.withColumn("ticker", F.upper(F.trim("ticker"))).join(known.select("ticker", "cik"), "ticker", "left")
