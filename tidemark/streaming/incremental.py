"""Runs that pick up where the last one stopped."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.operators.control import guarded
from tidemark.operators.lookup import upserted
from tidemark.operators.ranking import best_by


def upsert_folder(new: DataFrame, root: str, keys: list[str], keep: int = 2) -> str:
    """Write version n + 1 of a keyed table below ``root`` and return its place; readers take the newest finished one.

    The newest ``keep`` versions stay, for readers that have begun on one.
    """
    spark = new.sparkSession
    latest = newest_version(spark, root)
    old = spark.read.parquet(f"{root}/v{latest}") if latest else None
    table = upserted(old, new, keys) if old is not None else new
    path = f"{root}/v{latest + 1}"
    table.write.mode("overwrite").parquet(path)
    if latest + 1 > keep:
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/v{latest + 1 - keep}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return path


def merge_partitions(new: DataFrame, table: str, keys: list[str], buckets: int = 64) -> None:
    """Upsert into a Parquet folder parted by a hash of the keys; only the parts that ``new`` touches are written again."""
    spark = new.sparkSession
    part = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    more = new.withColumn("_part", part)
    touched = [r._part for r in more.select("_part").distinct().collect()]  # at most ``buckets``
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        old = spark.read.parquet(table).where(F.col("_part").isin(touched))
        more = upserted(old, more, keys)
    staged = f"{table}-staged"
    more.write.mode("overwrite").partitionBy("_part").parquet(staged)
    spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(table)
    gone = spark._jvm.org.apache.hadoop.fs.Path(staged)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def newest_version(spark: SparkSession, root: str) -> int:
    """The highest version with a success mark, 0 for none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    names = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("v")]
    return max([0, *(int(p.getName()[1:]) for p in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))])


def run_incrementally(stream: DataFrame, work: Callable[[DataFrame], DataFrame], root: str, keys: list[str], checkpoint: str):
    """Apply ``work`` to each micro-batch of what is there now, and upsert its last row for each key.

    A batch that is repeated after a failure writes the same keys again, so the
    table ends up the same.
    """

    def one(batch: DataFrame, number: int) -> None:
        done = work(batch)
        done = best_by(done, keys, [F.col("ord").desc()]) if "ord" in done.columns else done.dropDuplicates(keys)
        upsert_folder(done, root, keys)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Heartbeat(StreamingQueryListener):
    """Keeps the last progress of each query: batch, rows and rows a second."""

    def __init__(self) -> None:
        self.last: dict[str, tuple[int, int, float]] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.last.setdefault(str(event.id), (-1, 0, 0.0))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.last[str(p.id)] = (p.batchId, p.numInputRows, p.processedRowsPerSecond)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def waves(spark: SparkSession, path: str, schema: str, files: int) -> DataFrame:
    """A stream of a Parquet folder, ``files`` new files to a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def resumable(work: Callable[[Any], Any], seconds: float = 45.0) -> Callable[[Any], tuple[Any, str | None]]:
    """Per-record work that costs one record, not the job, if it fails or takes too long."""
    return guarded(work, seconds)
