"""Sessions, and how the package reaches the Python workers of a cluster."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
#: Tables written by ``kept``, by application.
_KEPT: dict[str, list[str]] = {}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings that the engine's semantics rely on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def once[T](build: Callable[..., T]) -> Callable[..., T]:
    """Keep what ``build`` makes of its (hashable) arguments, for columns over fixed names: large ones take the driver seconds to put together."""

    @functools.cache
    def made(app: str, *args) -> T:
        return build(*args)

    @functools.wraps(build)
    def found(*args) -> T:
        return made(SparkSession.getActiveSession().sparkContext.applicationId, *args)

    return found


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI below ``spark.checkpoint.dir``, or on one machine, where that isn't set, a temporary one; ``drop_kept`` deletes it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-kept-")
    uri = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _KEPT.setdefault(spark.sparkContext.applicationId, []).append(uri)
    return uri


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a ``shared_folder`` and read back, so that what builds on it several times plans and runs it once."""
    uri = shared_folder(df.sparkSession, name)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def drop_kept(spark: SparkSession) -> None:
    """Delete all shared folders of the application; DataFrames over them can't be read any more."""
    for uri in _KEPT.pop(spark.sparkContext.applicationId, []):
        path = spark._jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application.

    Workers then import it wherever they run, whether or not the repository is
    on their path.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tidemark-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors fetch it from the driver while the application runs
    to = os.path.join(folder, "tidemark.zip")
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(to)
    _SHIPPED.add(app)
