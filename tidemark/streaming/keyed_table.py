"""A keyed table in hash buckets, changed by small writes and one atomic commit.

A write makes new files for the buckets that it touches, in a folder of its
own, and then a manifest that says where each bucket's files are.  The manifest
gets its place by one rename: before that readers see the old table, after it
the new one, and a crash in between leaves files that nothing refers to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ranking import best_by


class Conflict(Exception):
    """Another writer has committed the version that this one was going to."""


class KeyedTable:
    """A table of one row for each key below the URI ``root``.

    The number of buckets is that of the first write.  Rows with equal keys in
    one write are an error of the caller's; null keys are keys like any other.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int = 64):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets

    # --- manifests --------------------------------------------------------------

    def _path(self, uri: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(uri)

    def _store(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The committed versions, oldest first."""
        folder, store = self._path(f"{self.root}/manifests"), self._store()
        if not store.exists(folder):
            return []
        names = [s.getPath().getName() for s in store.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """Of a version, the newest by default: buckets with their folders, the schema, and the last batch of a stream; that of an empty table is version 0."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return {"version": 0, "n": self.buckets, "files": {}, "schema": None, "batch": None}
        stream = self._store().open(self._path(f"{self.root}/manifests/{version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        store, name = self._store(), f"{self.root}/manifests/{manifest['version']}.json"
        staged = self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}")
        out = store.create(staged)
        out.write(json.dumps(manifest).encode())
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), conf)
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
        try:
            context.rename(staged, self._path(name), none)
        except Exception as e:
            store.delete(staged, False)
            if "AlreadyExists" in str(e):
                raise Conflict(name) from e
            raise

    # --- reading and writing ----------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default; later writes don't change what a reader has begun on."""
        manifest = self.manifest(version)
        if not manifest["schema"]:
            raise ValueError(f"{self.root} is empty")
        return self._rows(manifest, manifest["files"])

    def _rows(self, manifest: dict, buckets) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        places = [f"{self.root}/{manifest['files'][b]}" for b in sorted(buckets)]
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def upsert(self, new: DataFrame, batch: int | None = None, tries: int = 3) -> int:
        """Put the rows of ``new`` in place of those with their keys; return the version that has them.

        Only buckets that ``new`` touches are read and written.  A ``batch``
        that a version already has, or a later one, changes nothing, so a
        stream may repeat it.  If another writer commits first, the write is
        made anew on its version, ``tries`` times in all.
        """
        for k in range(tries):
            manifest = self.manifest()
            if batch is not None and manifest["batch"] is not None and batch <= manifest["batch"]:
                return manifest["version"]
            try:
                return self._write(new, manifest, batch)
            except Conflict:
                if k == tries - 1:
                    raise
        raise ValueError("tries must be positive")

    def _write(self, new: DataFrame, manifest: dict, batch: int | None) -> int:
        part = F.pmod(F.xxhash64(*self.keys), F.lit(manifest["n"])).cast("int")
        touched = [str(r[0]) for r in new.select(part).distinct().collect()]  # at most as many as there are buckets
        schema, merged = new.schema, new
        if there := [b for b in touched if b in manifest["files"]]:
            keys = new.select(*(F.col(k).alias(f"_new_{k}") for k in self.keys))
            same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in self.keys]
            merged = self._rows(manifest, there).join(keys, same, "left_anti").unionByName(new, allowMissingColumns=True)
            schema = merged.schema
        folder = f"data/{uuid.uuid4().hex}"
        if touched:
            dealt = merged.withColumn("_part", part).repartition(min(len(touched), 200), "_part")
            dealt.write.partitionBy("_part").parquet(f"{self.root}/{folder}")
        files = manifest["files"] | {b: f"{folder}/_part={b}" for b in touched}
        version = manifest["version"] + 1
        kept = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
        self._commit({"version": version, "n": manifest["n"], "files": files, "schema": kept.json(), "batch": manifest["batch"] if batch is None else batch})
        return version

    def vacuum(self, keep: int = 2) -> int:
        """Delete the versions before the newest ``keep`` and the buckets that only they have; return how many buckets went.

        Files of writes that aren't committed stay, as their writers may still be at work.
        """
        versions, store = self.versions(), self._store()
        old, new = versions[:-keep], versions[-keep:]
        used = {f for v in new for f in self.manifest(v)["files"].values()}
        gone = {f for v in old for f in self.manifest(v)["files"].values()} - used
        for v in old:  # manifests first, so that no version lacks files
            store.delete(self._path(f"{self.root}/manifests/{v}.json"), False)
        for f in gone:
            store.delete(self._path(f"{self.root}/{f}"), True)
        return len(gone)


def run_into(stream: DataFrame, work: Callable[[DataFrame], DataFrame], table: KeyedTable, order: str | None, checkpoint: str):
    """Apply ``work`` to each micro-batch of what is there now, and upsert its last row by ``order`` for each key.

    Batches carry their numbers into the table, so one that is repeated after
    a failure is applied once.
    """

    def one(batch: DataFrame, number: int) -> None:
        done = work(batch)
        table.upsert(best_by(done, table.keys, [F.col(order).desc_nulls_last()]) if order else done.dropDuplicates(table.keys), number)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
