"""Token ids in flat binary files with 64-bit document offsets.

A store is a folder of shards.  Shard ``NAME`` has three little-endian files:
``NAME.bin`` (the ids of all its documents, unsigned 16 or 32 bits),
``NAME.off`` (``n + 1`` signed 64-bit offsets into them, in ids) and
``NAME.doc`` (``n`` signed 64-bit document ids).  A manifest lists the shards
in document order; each shard's place in the whole is the sum of the sizes
before it.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch, owned, shared_dir
from tidemark.llm.tokens import encoder, resolve

MANIFEST = "path string, width int, n_docs long, n_tokens long, first_id long"


#: Hadoop's names of stores and those that pyarrow knows them by.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The store that a URI is in, and the path there; ValueError for stores that only Hadoop knows."""
    scheme, colon, rest = uri.partition(":")
    try:
        return fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)
    except pa.ArrowInvalid as e:
        raise ValueError(f"token files need a store that pyarrow can open, such as file, hdfs, s3, gs or abfss; not {uri}") from e


def _write(batches: Iterator[pa.RecordBatch], root: str, tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Write one shard for the partition; a repeated attempt writes files of another name, and a failed one none that the manifest lists."""
    store, path = store_of(root)
    coder = encoder(resolve(tokenizer))
    end = np.array([end_id], coder.dtype).tobytes()
    name = f"{path}/{uuid.uuid4().hex}"
    sizes, ids, out = [], [], None
    for batch in batches:
        ids.append(batch.column("id").to_numpy())
        for text in batch.column("text"):
            if out is None:
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{name}.bin")
            got = coder.encode(text.as_py())
            out.write(got.tobytes())
            out.write(end)
            sizes.append(len(got) + 1)
    if out is None:
        return
    out.close()
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
    docs = np.concatenate(ids).astype("<i8")
    for kind, data in (("off", offsets), ("doc", docs)):
        with store.open_output_stream(f"{name}.{kind}") as f:
            f.write(data.tobytes())
    yield pa.RecordBatch.from_pylist(
        [
            {
                "path": f"{root}/{name.rpartition('/')[2]}", "width": coder.dtype.itemsize, "n_docs": len(docs),
                "n_tokens": int(offsets[-1]), "first_id": int(docs[0])
            }
        ],
        pa.schema(
            [
                ("path", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                ("first_id", pa.int64())
            ]
        )
    )


def write_tokens(docs: DataFrame, root: str, *, tokenizer: str, end_id: int, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode ``docs`` into a store below the URI ``root`` and return its manifest.

    The store is a new folder in ``root``; what else is there isn't touched.
    Shards are ranges of ids, each in ascending order.  Rows with a null id
    have no place in the order and are left out.
    """
    root = f"{root.rstrip('/')}/tokens-{uuid.uuid4().hex}"
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("id is not null")
    dealt = base.repartitionByRange("id").sortWithinPartitions("id")
    manifest = scratch.keep(dealt.mapInArrow(lambda it: _write(it, root, tokenizer, end_id), MANIFEST), "manifest")
    _sweep(manifest, root)
    return manifest


def _sweep(manifest: DataFrame, root: str) -> None:
    """Delete what lost or repeated attempts have left in a store of this run's own."""
    spark = manifest.sparkSession
    listed = {r.path.rpartition("/")[2] for r in manifest.select("path").collect()}  # one row for each shard
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(path):
        for s in store.listStatus(path):
            if s.getPath().getName().split(".")[0] not in listed:
                store.delete(s.getPath(), False)


class RemoteArray:
    """A flat file of a remote store, read by ranges as slices ask for them."""

    def __init__(self, store: fs.FileSystem, path: str, dtype: np.dtype):
        self.file, self.dtype = store.open_input_file(path), dtype

    def __len__(self) -> int:
        return self.file.size() // self.dtype.itemsize

    def __getitem__(self, part: slice) -> np.ndarray:
        begin, end, _ = part.indices(len(self))
        return np.frombuffer(self.file.read_at(max(0, end - begin) * self.dtype.itemsize, begin * self.dtype.itemsize), self.dtype)


def opened(path: str, dtype: str) -> np.ndarray | RemoteArray:
    """Map a local file into memory."""
    store, at = store_of(path)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(at, dtype, "r") if os.path.getsize(at) else np.zeros(0, dtype)
    return RemoteArray(store, at, np.dtype(dtype))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard in batch.to_pylist():
            ids, offsets, docs = opened(
                shard["path"] + ".bin", f"<u{shard['width']}"
            ), opened(shard["path"] + ".off", "<i8"), opened(shard["path"] + ".doc", "<i8")
            for at in range(0, len(docs), 4096):
                to = min(len(docs), at + 4096)
                cut = np.asarray(offsets[at : to + 1])
                some = ids[int(cut[0]) : int(cut[-1])]
                crc = [zlib.crc32(np.asarray(some[a:b]).astype("<u4").tobytes()) for a, b in zip(cut[:-1] - cut[0], cut[1:] - cut[0], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.asarray(docs[at:to])), pa.array(cut[:-1] + shard["base"]), pa.array(np.diff(cut)),
                        pa.array(crc, pa.int64())
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"]
                )


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Return doc_id, start, n_tokens and ids_crc32 of every document of a store, from its files."""
    shards = manifest.orderBy("first_id").collect()  # one row for each shard
    bases = [0, *accumulate(s.n_tokens for s in shards)]
    rows = [(s.path, s.width, b) for s, b in zip(shards, bases, strict=False)]
    dealt = spark.createDataFrame(rows, "path string, width int, base long").repartition(max(1, len(rows)), "path")
    return dealt.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_round_trip(
    docs: DataFrame, *, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    root: str | None = None
) -> DataFrame:
    """Write a store and return what its files say of each document.

    A null or empty text is the end id alone.  Rows that repeat an id stand
    side by side in any order; a row with a null id isn't stored and comes back
    with null figures.  Other columns are ignored; an empty table gives an
    empty store.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    manifest = write_tokens(
        docs, root or owned(spark, f"{shared_dir(spark)}/token-store-{uuid.uuid4().hex}"), tokenizer=tokenizer, end_id=end_id,
        scratch=scratch, id_col=id_col, text_col=text_col
    )
    lost = docs.where(F.col(id_col).isNull()).selectExpr(
        "cast(null as long) as doc_id", "cast(null as long) as start", "cast(null as long) as n_tokens",
        "cast(null as long) as ids_crc32"
    )
    return read_tokens(spark, manifest).unionByName(lost)
