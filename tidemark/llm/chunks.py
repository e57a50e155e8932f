"""Chunks of documents: compressed rows that several passes read again.

A chunk holds the texts of many documents as one zstd blob of a few MB.  A pass
turns each chunk into a few rows of packed arrays, deals them out by hash
ranges, and answers come back by chunk; no pass makes a row for each word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import text_bytes, text_slices

CHUNK_SCHEMA = "chunk long, grp int, n_docs int, n_bytes long, ids binary, ends binary, blob binary"


def release() -> None:
    """Give memory that is free back to the system; a worker lives through many tasks and else keeps its peak."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


_CHUNK_ARROW = pa.schema(
    [
        ("chunk", pa.int64()), ("grp", pa.int32()), ("n_docs", pa.int32()), ("n_bytes", pa.int64()), ("ids", pa.binary()),
        ("ends", pa.binary()), ("blob", pa.binary())
    ]
)


def _packed(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    coder = zstandard.ZstdCompressor(level=3)
    held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

    def flushed(group: int) -> pa.RecordBatch:
        nonlocal number
        ids, sizes, data = (np.concatenate(x) for x in zip(*held.pop(group), strict=True))
        row = {
            "chunk": number, "grp": group, "n_docs": len(ids), "n_bytes": len(data), "ids": ids.tobytes(),
            "ends": np.cumsum(sizes).tobytes(), "blob": coder.compress(data)
        }
        number += 1
        return pa.RecordBatch.from_pylist([row], _CHUNK_ARROW)

    for batch in batches:
        groups = batch.column("grp").to_numpy()
        for g in np.unique(groups).tolist():
            some = batch.filter(pa.array(groups == g)) if (groups != g).any() else batch
            for part in text_slices(some, "text", limit):
                data, offsets = text_bytes(part.column("text"))
                held.setdefault(g, []).append((part.column("id").to_numpy(zero_copy_only=False).astype(np.int64), np.diff(offsets), data.copy()))
                if sum(len(d) for _, _, d in held[g]) >= limit // 2:
                    yield flushed(g)
        release()
    for g in list(held):
        yield flushed(g)


def pack_chunks(docs: DataFrame, limit: int = 2 << 20) -> DataFrame:
    """Pack (id long, text) into chunks of about ``limit`` bytes, or of one document.

    A column ``grp`` of a few integers, if there is one, parts the documents:
    each chunk is of one group.  ``id`` must not be null; a null text counts as
    empty.  Chunk numbers are those of the task that writes them, so write the
    result before using it twice.
    """
    group = F.col("grp").cast("int") if "grp" in docs.columns else F.lit(0)
    return docs.select("id", F.coalesce("text", F.lit("")).alias("text"), group.alias("grp")).mapInArrow(lambda it: _packed(it, limit), CHUNK_SCHEMA)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit integers in few bytes: differences, byte by byte, compressed."""
    step = np.diff(keys, prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T), 1)


def unpacked_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, most of them small, in few bytes."""
    return zstandard.compress(np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T), 1)


def unpacked_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Return a chunk's ids, ``n + 1`` offsets and bytes."""
    ids = np.frombuffer(row["ids"], np.int64)
    offsets = np.concatenate([[0], np.frombuffer(row["ends"], np.int64)])
    blob = row["blob"]
    data = np.frombuffer(
        zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, row["n_bytes"])), np.uint8
    ) if row["n_bytes"] else np.zeros(0, np.uint8)
    return ids, offsets, data


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Yield the rows of Arrow batches as dictionaries, binary columns without copies."""
    for batch in batches:
        cols = {n: batch.column(n) for n in batch.schema.names}
        for i in range(batch.num_rows):
            yield {n: (memoryview(c[i].as_buffer()) if pa.types.is_binary(c.type) and c[i].is_valid else c[i].as_py()) for n, c in cols.items()}
            if i % 4 == 3:
                release()
    release()


def runs(sorted_hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of the equal hash ranges, of ``parts``, that sorted unsigned hashes fall into, and where each one's begin and end.

    The work doesn't depend on how many ranges there are.
    """
    number = np.minimum(sorted_hashes // np.uint64((1 << 64) // parts if parts > 1 else (1 << 64) - 1), np.uint64(parts - 1)).astype(np.int64)
    begin = np.flatnonzero(np.diff(number, prepend=-1))
    return number[begin], begin, np.append(begin[1:], len(number))[: len(begin)]
