"""Packing of documents into training sequences by length patterns.

Sequences are planned on the histogram of piece lengths alone, whose size is
the capacity's and not the corpus's.  Patterns of one to three lengths that
fill a sequence are enumerated; non-negative least squares fits how often each
should repeat to use up the histogram; the counts are rounded, and what is left
is packed by best fit.  The plan is a list of runs: pieces of length ``l`` with
ranks ``from`` to ``to`` go to consecutive sequences at a fixed offset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch
from tidemark.llm.tokens import encoder, resolve


def patterns(capacity: int, present: np.ndarray, grid: int) -> np.ndarray:
    """Return (n, 3) rows of lengths, 0 for none, that fill ``capacity`` exactly.

    Pairs are all there are; of triples the smallest length is a multiple of
    ``grid``, so that there are some tens of thousands.
    """
    found = [np.array([[capacity, 0, 0]])]
    a = np.arange(1, capacity // 2 + 1)
    found.append(np.stack([capacity - a, a, 0 * a], axis=1))
    for least in range(grid, capacity // 3 + 1, grid):
        mid = np.arange(least, (capacity - least) // 2 + 1)
        found.append(np.stack([capacity - least - mid, mid, 0 * mid + least], axis=1))
    rows = np.concatenate(found)
    return rows[(present[rows] | (rows == 0)).all(axis=1)]


def fit(rows: np.ndarray, histogram: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """Non-negative least squares by coordinate descent: repeats of each pattern, so that the pieces used match the histogram."""
    rest = histogram.astype(np.float64).tolist()
    x = [0.0] * len(rows)
    parts = []
    for row in rows.tolist():
        use: dict[int, int] = {}
        for length in row:
            if length:
                use[length] = use.get(length, 0) + 1
        parts.append((list(use.items()), float(sum(k * k for k in use.values()))))
    for _ in range(sweeps):
        moved = 0.0
        for j, (use, norm) in enumerate(parts):
            step = max(-x[j], sum(k * rest[length] for length, k in use) / norm)
            if step > 1e-3 or step < -1e-3:
                x[j] += step
                for length, k in use:
                    rest[length] -= k * step
                moved += abs(step)
        if moved < 1e-3 * max(1.0, float(histogram.sum())):
            break
    return np.array(x)


def plan(histogram: np.ndarray, grid: int = 32) -> np.ndarray:
    """Return runs (length, first rank, end rank, first sequence, offset) that place every piece.

    ``histogram[l]`` is the number of pieces of length ``l``; its last index is
    the capacity.
    """
    capacity = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    used = np.zeros_like(left)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    rows = patterns(capacity, left > 0, grid)
    repeats = fit(rows, left)
    # Groups of sequences alike: (first sequence, number, filled so far), by room left.
    rooms: dict[int, list[tuple[int, int]]] = {}

    def put(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, int(used[length]), int(used[length]) + n, first, offset))
        used[length] += n
        left[length] -= n

    for j in np.argsort(-repeats, kind="stable").tolist():
        n = int(np.floor(repeats[j] + 0.5))
        if n <= 0:
            break
        row = [length for length in rows[j].tolist() if length]
        n = min([n, *[int(left[length]) // row.count(length) for length in row]])
        if n <= 0:
            continue
        at = 0
        for length in row:
            put(length, n, sequences, at)
            at += length
        sequences += n
    # The rest by best fit, longest first, whole groups at a time.
    open_rooms = np.zeros(capacity + 1, bool)
    for length in range(capacity, 0, -1):
        while left[length]:
            fitting = np.flatnonzero(open_rooms[length:])
            if len(fitting):
                room = length + int(fitting[0])
                first, n = rooms[room].pop()
                take = min(n, int(left[length]))
                if take < n:
                    rooms[room].append((first + take, n - take))
                if not rooms[room]:
                    open_rooms[room] = False
                put(length, take, first, capacity - room)
                after = room - length
            else:
                # A new sequence takes as many copies of this length as fit.
                each = capacity // length
                n = int(left[length])
                whole = n // each
                if whole:
                    first, take = sequences, whole
                    for k in range(each):
                        put(length, whole, first, k * length)
                    after = capacity - each * length
                else:
                    first, take = sequences, 1
                    for k in range(n):
                        put(length, 1, first, k * length)
                    after = capacity - n * length
                sequences += take
            if after:
                rooms.setdefault(after, []).append((first, take))
                open_rooms[after] = True
    return np.array(runs, np.int64).reshape(-1, 5)


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    coder = encoder(resolve(tokenizer))
    for batch in batches:
        out: list[tuple] = []
        for i, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
            ids = np.append(coder.encode(text.as_py()).astype("<u4"), np.array([end_id], "<u4"))
            head = len(ids) % capacity or capacity
            edges = [0, *range(head, len(ids) + 1, capacity)]
            out += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])


def _placed(batches: Iterator[pa.RecordBatch], runs: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    runs = runs[order]
    keys = runs[:, 0] << 44 | runs[:, 1]
    for batch in batches:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        at = np.searchsorted(keys, length << 44 | rank, "right") - 1
        sequence = runs[at, 3] + rank - runs[at, 1]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(runs[at, 4])], [*names, "sequence_id", "offset"])


def pack(
    docs: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id",
    text_col: str = "text", group_rows: int = 20_000
) -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` tokens, as few as possible.

    Returns one row for each piece: doc_id, piece, start, length, ids_crc32,
    sequence_id and offset.  Only longer documents are cut, so that all pieces
    but the first are full.  The pieces of a sequence stand in any order and
    without gaps.

    A null or empty text is the end id alone.  Rows with a null id or a
    repeated one are packed like all others.  Other columns are ignored; an
    empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    made = scratch.keep(
        base.mapInArrow(
            lambda it: _pieces(it, tokenizer, end_id, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long"
        ),
        "pieces"
    )
    counts = made.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``capacity`` rows
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts:
        histogram[r.length] = r.n
    runs = plan(histogram)
    # Ranks within a length: groups of bounded size, as many as there are tasks, and the sizes of the groups before.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(-(-int(histogram.max()) // group_rows), min(tasks, -(-int(histogram.max()) // 200)), 1)
    salted = made.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = sizes.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    inner = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("inner", inner).join(before, ["length", "salt"]).withColumn("rank", (F.col("inner") + F.col("before")).cast("long"))
    placed = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        lambda it: _placed(it, runs),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return scratch.result(placed)
