"""Intermediate tables in the shared folder that the cluster names.

Long jobs cut their lineage by writing a Parquet table below
``spark.checkpoint.dir`` and reading it again, so a lost executor costs one
stage and not the whole job.  Only where that setting is absent and Spark runs
on this machine alone (unit tests) a temporary folder is used.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.session import ship

_FALLBACK: dict[str, str] = {}
#: Results that stay until ``drop_results``, by application.
_RESULTS: dict[str, list[str]] = {}
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """Return the folder that the driver and all executors share, as a URI."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return _FALLBACK[app]


def delete(spark: SparkSession, uri: str) -> None:
    """Delete a folder of the shared store, whatever file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def owned(spark: SparkSession, uri: str) -> str:
    """Mark a folder as a result, to be deleted by ``drop_results``."""
    _RESULTS.setdefault(spark.sparkContext.applicationId, []).append(uri)
    return uri


def results_so_far(spark: SparkSession) -> int:
    """How many results there are, to drop only later ones."""
    return len(_RESULTS.get(spark.sparkContext.applicationId, []))


def drop_results(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables and files behind all results but the first ``since``; DataFrames over them can't be read any more."""
    made = _RESULTS.get(spark.sparkContext.applicationId, [])
    for uri in made[since:]:
        delete(spark, uri)
    del made[since:]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Send rows to Python workers by the thousand for one action, as rows here hold whole texts; then as before."""
    before = spark.conf.get(_BATCH, "10000")
    if int(before) <= rows and int(before) > 0:
        yield
        return
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


class Scratch:
    """The tables of one job.

    ``keep`` writes a DataFrame and returns it as read back.  ``result`` does
    so with the job's outcome and deletes every other table of the job.
    """

    def __init__(self, spark: SparkSession, job: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{job}-{uuid.uuid4().hex}"
        self.made: dict[str, str] = {}
        self.number = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back."""
        self.number += 1
        uri = f"{self.root}/{name}-{self.number}"
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
        with small_batches(self.spark):
            df.write.parquet(uri)
        self.made[name] = uri
        return self.spark.read.schema(schema).parquet(uri)

    def drop(self, name: str) -> None:
        delete(self.spark, self.made.pop(name))

    def result(self, df: DataFrame) -> DataFrame:
        """Write the outcome and delete all other tables."""
        out = self.keep(df, "result")
        owned(self.spark, self.made["result"])
        for name in [n for n in self.made if n != "result"]:
            self.drop(name)
        return out
