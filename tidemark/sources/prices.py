"""Stored price responses as a Spark data source: planned waves of files, paced and retried inside the reader."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.session import ship

SCHEMA = "ticker string, price double, error string"
_ARROW = pa.schema([("ticker", pa.string()), ("price", pa.float64()), ("error", pa.string())])


class Wave(InputPartition):
    """Files that one task asks for, one after another."""

    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class PriceReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.wave = options["path"], int(options.get("wave", 50))
        self.tries, self.pause, self.rate = int(options.get("tries", 3)), float(options.get("pause", 0.2)), float(options.get("persecond", 0))

    def partitions(self) -> Sequence[InputPartition]:
        """Waves of files in the order of their names, as a list of the folder; no file is opened here."""
        store, path = fs.FileSystem.from_uri(self.root)
        found = sorted(f.path for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".json"))
        return [Wave(found[a : a + self.wave]) for a in range(0, len(found), self.wave)] or [Wave([])]

    def _asked(self, store: fs.FileSystem, path: str) -> tuple[float | None, str | None]:
        """A file's price, or why there is none; what may pass is tried again, later and later."""
        for k in range(self.tries):
            try:
                with store.open_input_stream(path) as f:
                    told = json.loads(f.read())
                price = told.get("price") if isinstance(told, dict) else None
                return (float(price), None) if isinstance(price, int | float) and price > 0 else (None, "no price")
            except ValueError:
                return None, "no price"
            except OSError as e:
                if k == self.tries - 1:
                    return None, f"failed: {e}"[:200]
                time.sleep(self.pause * 2**k)
        return None, "failed"

    def read(self, partition: Wave) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.root)
        rows, due = [], time.monotonic()
        for path in partition.paths:
            if self.rate:
                time.sleep(max(0.0, due - time.monotonic()))
                due = max(due, time.monotonic()) + 1 / self.rate
            price, error = self._asked(store, path)
            rows.append({"ticker": path.rpartition("/")[2][:-5].strip().upper(), "price": price, "error": error})
        yield pa.RecordBatch.from_pylist(rows, _ARROW)


class StoredPrices(DataSource):
    """``stored_prices``: a folder with one JSON response a symbol, ``SYMBOL.json`` holding ``price``.

    Options: path, wave (files to a task, 50), tries (3), pause (seconds before
    the second try, doubled for each further one), persecond (requests of a
    task, 0 for as many as come).
    """

    @classmethod
    def name(cls) -> str:
        return "stored_prices"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PriceReader(self.options)


def stored_prices(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """(ticker, price, error) of a folder of responses, by the ``stored_prices`` source."""
    ship(spark)
    spark.dataSource.register(StoredPrices)
    return spark.read.format("stored_prices").options(**{k: str(v) for k, v in options.items()}).load(path)


def _stored(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    store, path = fs.FileSystem.from_uri(root)
    store.create_dir(path, recursive=True)
    for batch in batches:
        for ticker, price in zip(batch.column("ticker").to_pylist(), batch.column("price").to_pylist(), strict=True):
            with store.open_output_stream(f"{path}/{ticker}.json") as f:
                f.write(json.dumps({"price": price}).encode())
        yield pa.RecordBatch.from_pylist([{"n": batch.num_rows}])


def store_responses(prices: DataFrame, root: str) -> int:
    """Write (ticker, price) as one response a ticker below ``root``, as a fetcher stores them; return how many."""
    ship(prices.sparkSession)
    done = prices.select("ticker", F.col("price").cast("double").alias("price")).mapInArrow(lambda it: _stored(it, root), "n long")
    return done.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_prices(wanted: DataFrame, folders: Sequence[str], **options: object) -> DataFrame:
    """(ticker, price, source, reason) of each wanted ticker: the first folder's price above 0, or why there is none.

    Tickers are trimmed and in upper case; null and empty ones are left out.
    ``reason`` is ``no data`` where no folder has a response, else the last
    folder's error.
    """
    keys = wanted.select(F.upper(F.trim("ticker")).alias("ticker")).where("ticker <> ''").distinct()
    every = None
    for k, folder in enumerate(folders):
        one = stored_prices(wanted.sparkSession, folder, **options).withColumn("source", F.lit(k))
        every = one if every is None else every.unionByName(one)
    best = every.groupBy("ticker").agg(
        F.min(F.when(F.col("price").isNotNull(), F.struct("source", "price"))).alias("best"), F.max(F.when(F.col("price").isNull(), F.struct("source", "error"))).alias("last")
    )
    found = keys.join(best, "ticker", "left")
    reason = F.when(F.col("best").isNotNull(), None).otherwise(F.coalesce("last.error", F.lit("no data")))
    return found.select("ticker", F.col("best.price").alias("price"), F.col("best.source").alias("source"), reason.alias("reason"))
