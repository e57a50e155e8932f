"""Prices and exchange rates from pluggable sources.

A source is a function from a DataFrame of wanted keys to answers; here they
read the responses that a fetcher has stored, since the engine itself opens no
connection.  Sources stand in order of priority, and a later one is only asked
for what those before it left open.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import as_double

#: (ticker) to (ticker, price, reason): a price above 0, or why there is none.
Source = Callable[[DataFrame], DataFrame]
QUOTES = "quoteResponse struct<result:array<struct<symbol:string,regularMarketPrice:double>>>"
PREVIOUS = "ticker string, status string, results array<struct<c:double>>"
GROUPED = "status string, results array<struct<T:string,c:double>>"


def chunked(keys: DataFrame, key: str, size: int) -> DataFrame:
    """(chunk, keys): wanted keys in sorted batches of ``size``, for sources that take several at once.

    Meant for lists of symbols: their numbering is one window over all keys.
    """
    ranked = keys.select(key).distinct().withColumn("_n", F.row_number().over(Window.orderBy(key)) - 1)
    return ranked.groupBy(F.floor(F.col("_n") / size).alias("chunk")).agg(F.sort_array(F.collect_list(key)).alias("keys"))


def batch_quotes(spark: SparkSession, path: str) -> Source:
    """Stored responses of a batch quote service: JSON with a list of symbols and prices."""
    def ask(wanted: DataFrame) -> DataFrame:
        got = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", QUOTES)["quoteResponse"]["result"]).alias("r"))
        return _answers(wanted, got.select(F.upper("r.symbol").alias("ticker"), F.col("r.regularMarketPrice").alias("price")))

    return ask


def daily_csv(spark: SparkSession, path: str, suffix: str = ".US") -> Source:
    """Stored responses of a daily CSV service, ``Symbol,Date,Time,Open,High,Low,Close,Volume``."""
    def ask(wanted: DataFrame) -> DataFrame:
        cells = spark.read.text(path).select(F.split("value", ",").alias("c")).where("size(c) >= 7 and lower(c[0]) <> 'symbol'")
        return _answers(
            wanted,
            cells.select(
                F.replace(F.upper(F.col("c")[0]), F.lit(suffix), F.lit("")).alias("ticker"),
                as_double(F.col("c")[6]).alias("price")
            )
        )

    return ask


def previous_close(spark: SparkSession, path: str) -> Source:
    """Stored responses of a previous-close service: one JSON for each symbol."""
    def ask(wanted: DataFrame) -> DataFrame:
        got = spark.read.text(path, wholetext=True).select(F.from_json("value", PREVIOUS).alias("r"))
        return _answers(wanted, got.select(F.upper("r.ticker").alias("ticker"), F.get("r.results", F.lit(0))["c"].alias("price")))

    return ask


def grouped_daily(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, close) of a stored grouped-daily response, closes above 0, by symbol; the last of equal symbols counts."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", GROUPED)["results"]).alias("pos", "r"))
    some = rows.where("r.c > 0 and trim(r.T) <> ''").groupBy(F.upper(F.trim("r.T")).alias("symbol")).agg(F.max_by("r.c", "pos").alias("close"))
    return some.orderBy("symbol")


def _answers(wanted: DataFrame, got: DataFrame) -> DataFrame:
    best = got.where("ticker is not null").groupBy("ticker").agg(F.max("price").alias("price"))
    reason = F.when(F.col("_there").isNull(), "no data").when(F.coalesce(F.col("price") > 0, F.lit(False)), None).otherwise("no price")
    found = wanted.select("ticker").distinct().join(best.withColumn("_there", F.lit(True)), "ticker", "left")
    return found.select("ticker", F.when(F.col("price") > 0, F.col("price")).alias("price"), reason.alias("reason"))


def fetched_prices(wanted: DataFrame, sources: Sequence[tuple[str, Source]]) -> DataFrame:
    """(ticker, price, source, reason): the first source's price of each ticker, or the last reason why there is none."""
    open_, out = wanted.select(F.upper(F.trim("ticker")).alias("ticker")).where("ticker <> ''").distinct(), None
    for name, ask in sources:
        got = ask(open_).withColumn("source", F.when(F.col("price").isNotNull(), name))
        done = got.where("price is not null")
        out = done if out is None else out.unionByName(done)
        last, open_ = got.where("price is null"), got.where("price is null").select("ticker")
    return out.unionByName(last).select("ticker", "price", "source", "reason")


def failure_reasons(found: DataFrame, reason: str = "reason") -> DataFrame:
    """(reason, n) of what failed, by reason."""
    return found.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("n")).orderBy(reason)


def rates_to_usd(codes: DataFrame, sources: Sequence[DataFrame]) -> DataFrame:
    """(currency, usd_per_unit, source): one over the first source's rate above 0 of each code, USD as 1.

    ``sources`` hold (currency, per_usd) and stand in order of priority.
    """
    every = None
    for k, s in enumerate(sources):
        one = s.where("per_usd > 0").select(F.upper("currency").alias("currency"), F.lit(k).alias("source"), (1 / F.col("per_usd")).alias("usd_per_unit"))
        every = one if every is None else every.unionByName(one)
    best = every.groupBy("currency").agg(F.min(F.struct("source", "usd_per_unit")).alias("m"))
    wanted = codes.select(F.upper(F.trim("currency")).alias("currency")).where("currency <> ''").distinct()
    usd = F.col("currency") == "USD"
    found = wanted.join(best, "currency", "left")
    return found.select("currency", F.when(usd, 1.0).otherwise(F.col("m.usd_per_unit")).alias("usd_per_unit"), F.when(~usd, F.col("m.source")).alias("source"))


def wanted_tickers(summary: DataFrame, ticker: str = "ticker") -> DataFrame:
    """The different tickers of a summary, trimmed and in upper case."""
    return summary.select(F.upper(F.trim(ticker)).alias("ticker")).where("ticker <> ''").distinct()


def in_folder(path: Column, ticker: str) -> Column:
    """Whether a file stands in the ticker's folder, whatever the case of its name."""
    return F.upper(F.regexp_extract(path, "([^/]+)/[^/]+$", 1)) == ticker.strip().upper()
