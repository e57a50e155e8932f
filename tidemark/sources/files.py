"""Input files as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import as_double
from tidemark.functions.text import path_ticker
from tidemark.sources.market import in_folder

FILING_GLOB = "*.{htm,html,txt,xml,xhtml}"
PROGRESS = "map<string,struct<status:string,form:string,file:string,date:string,reason:string>>"
SUBMISSIONS = "struct<filings:struct<recent:struct<form:array<string>,accessionNumber:array<string>,primaryDocument:array<string>,filingDate:array<string>>>>"


def tickers(spark: SparkSession, path: str) -> DataFrame:
    """(ord, ticker) of a list with one ticker to a line; ``#`` starts a comment line."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.upper(F.trim("value")).alias("ticker"))
    return lines.where("ticker <> '' and ticker not like '#%'")


#: The older parser's kinds of files.
OLD_GLOB = "*.{htm,html,txt}"


def filings(spark: SparkSession, path: str, glob: str = FILING_GLOB, ticker: str | None = None) -> DataFrame:
    """(filing_id, path, name, ticker, raw) of all filings below a folder, or of a ticker's folder there, whatever its case.

    Hidden files and the progress file are none; bytes that aren't UTF-8 are
    read as Latin-1.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    files = files.where("path not rlike '/[.][^/]*$' and path not like '%/progress.json'")
    if ticker is not None:
        files = files.where(in_folder(F.col("path"), ticker))
    text = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", "ISO-8859-1"))
    return files.select(
        F.col("path").alias("filing_id"), "path", F.regexp_extract("path", "([^/]+)$", 1).alias("name"),
        path_ticker(F.col("path")).alias("ticker"), text.alias("raw")
    )


def master_index(spark: SparkSession, path: str) -> DataFrame:
    """(cik, company, form, filed, path) of quarterly index files; lines without five fields are headers."""
    parts = spark.read.text(path).select(F.split("value", r"\|").alias("p")).where(F.size("p") >= 5)
    return parts.select(
        *(F.trim(F.col("p")[i]).alias(n) for i, n in enumerate(("cik", "company", "form", "filed", "path")))
    ).where("try_to_date(filed, 'yyyy-MM-dd') is not null")


def submissions(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, form, accession, document, filed) from parallel arrays, in feed order."""
    return parsed_submissions(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value"))


def parsed_submissions(texts: DataFrame) -> DataFrame:
    """The same of (path, value) with the JSON in ``value``."""
    raw = texts.select("path", F.from_json("value", SUBMISSIONS).alias("s"))
    recent = F.arrays_zip(*(F.col(f"s.filings.recent.{n}").alias(n) for n in ("form", "accessionNumber", "primaryDocument", "filingDate")))
    return raw.select("path", F.posexplode(recent).alias("pos", "r")).select(
        "path", "pos", "r.form", F.col("r.accessionNumber").alias("accession"), F.col("r.primaryDocument").alias("document"),
        F.col("r.filingDate").alias("filed")
    )


def company_tickers(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, cik) with ten-digit ciks."""
    raw = spark.read.text(path, wholetext=True).select(
        F.explode(F.map_values(F.from_json("value", "map<string,struct<ticker:string,cik_str:bigint>>"))).alias("c")
    )
    return raw.select(F.upper("c.ticker").alias("ticker"), F.lpad(F.col("c.cik_str").cast("string"), 10, "0").alias("cik"))


def progress(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, status, form, file, date, reason) of a progress file; a damaged file is empty."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", PROGRESS)).alias("ticker", "r")).select("ticker", "r.*")


def prices(spark: SparkSession, path: str, symbol: str = "symbol", price: str = "close") -> DataFrame:
    """(ticker, price) of a CSV file; see ``parsed_prices``."""
    return parsed_prices(spark.read.text(path, wholetext=True), symbol, price)


def parsed_prices(texts: DataFrame, symbol: str = "symbol", price: str = "close") -> DataFrame:
    """(ticker, price) of whole CSV texts in ``value``: any of four separators, columns in any case, ``.US`` off, prices above 0, the last line of a ticker wins."""
    lines = texts.select(F.split(F.regexp_replace("value", "\r\n?", "\n"), "\n").alias("l"))
    head = F.regexp_replace(F.col("l")[0], "^﻿", "")
    sep = F.when(head.contains(";"), ";").when(head.contains("\t"), "\t").when(head.contains("|"), r"\|").otherwise(",")
    cells = lines.select(
        F.transform(F.split(F.lower(head), sep), lambda x: F.trim(F.replace(x, F.lit('"'), F.lit("")))).alias("names"),
        sep.alias("sep"), F.posexplode("l").alias("pos", "line")
    ).where("pos > 0 and trim(line) <> ''")
    cell = lambda name: F.trim(
        F.replace(
            F.get(F.split("line", F.col("sep")), F.array_position("names", F.lit(name.lower())).cast("int") - 1), F.lit('"'),
            F.lit("")
        )
    )
    rows = cells.select(
        "pos", F.replace(F.upper(cell(symbol)), F.lit(".US"), F.lit("")).alias("ticker"), as_double(cell(price)).alias("price")
    ).where("ticker <> '' and price > 0")
    return rows.groupBy("ticker").agg(F.max(F.struct("pos", "price")).alias("m")).select("ticker", "m.price")


def exchange_rates(quotes: DataFrame) -> DataFrame:
    """(currency, usd_per_unit) from (currency, per_usd), rates above 0; USD is 1."""
    usd = quotes.sparkSession.createDataFrame([("USD", 1.0)], "currency string, usd_per_unit double")
    return quotes.where("per_usd > 0 and currency <> 'USD'").select("currency", (1 / F.col("per_usd")).alias("usd_per_unit")).union(usd)


def cached_rows(cache: DataFrame) -> DataFrame:
    """All of a cache table, null texts as empty ones."""
    return cache.select(*((F.coalesce(c, F.lit("")) if kind == "string" else F.col(c)).alias(c) for c, kind in cache.dtypes))
