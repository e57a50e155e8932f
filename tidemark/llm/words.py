"""Vectorised text primitives on Arrow string columns.

The hash of a span takes its bytes eight at a time through a mixing function,
so that spans of any length and likeness get independent 64-bit values.  The
function can be run backwards, so texts can be made that collide under a known
seed; jobs that take equal hashes for equal words draw a secret one for each run.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: An odd constant, and the finaliser's multipliers (splitmix64).
BASE = 0x9E3779B97F4A7C15
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Spans of more bytes are hashed one by one.
LONG = 1024

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that aren't ASCII letters or digits, nor part of other characters.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Mix all bits of unsigned 64-bit integers."""
    shifted = x >> np.uint64(30)
    x = x ^ shifted
    x *= MIX_A
    np.right_shift(x, np.uint64(27), out=shifted)
    x ^= shifted
    x *= MIX_B
    np.right_shift(x, np.uint64(31), out=shifted)
    x ^= shifted
    return x


def lanes(data: np.ndarray) -> np.ndarray:
    """Eight bytes from every position on as an integer; past the end there are zeros."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 8,), "<u8", padded, strides=(1,))


def new_seed() -> int:
    """A secret seed: no text can be made to collide under it."""
    return secrets.randbits(62) + 1


def _subkeys(seed: int) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(seed.to_bytes(8, "little"), digest_size=16).digest(), "<u8")


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Return a 64-bit hash of the bytes of each span; each ``seed`` gives another."""
    size = ends - starts
    at8 = lanes(data)
    begin, finish = _subkeys(seed)
    code = mix64(size.astype(np.uint64) * MIX_A + begin)
    live, k = np.flatnonzero((size > 0) & (size <= LONG)), 0
    while len(live):
        left = size[live] - k
        lane = at8[starts[live] + k]
        short = left < 8
        lane[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        code[live] = mix64(code[live] * np.uint64(BASE) ^ lane)
        live, k = live[left > 8], k + 8
    code = mix64(code ^ finish)
    for i in np.flatnonzero(size > LONG).tolist():
        code[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    return code


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from each of ``a`` equal those from ``b``, byte for byte."""
    at8 = lanes(data)
    same = np.ones(len(a), bool)
    live, k = np.flatnonzero(size > 0), 0
    while len(live):
        left = size[live] - k
        lane = at8[a[live] + k] ^ at8[b[live] + k]
        short = left < 8
        lane[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        same[live[lane != 0]] = False
        live, k = live[(left > 8) & (lane == 0)], k + 8
    return same


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has about ``limit`` bytes of text, or one row."""
    text = batch.column(column)
    n = len(text)
    if not n:
        return
    offsets = np.frombuffer(text.buffers()[1], np.int32, n + 1, 4 * text.offset) if pa.types.is_string(text.type) else None
    if offsets is None:
        raise TypeError(f"{column} must be a string column")
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, int(offsets[at]) + limit, "left"))
        to = min(n, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Return a string column's bytes and its ``n + 1`` offsets; nulls are empty."""
    n = len(text)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if text.null_count:
        text = text.fill_null("")
    offsets = np.frombuffer(text.buffers()[1], np.int32, n + 1, 4 * text.offset).astype(np.int64)
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8, int(offsets[-1]))[int(offsets[0]) :] if raw is not None and offsets[-1] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z only."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Return starts and ends of words and, for each document, the number of words before it.

    ``gap`` flags the bytes between words, by default ``[\\x20\\x09-\\x0D]``.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~gap[data]
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | first[1:]
    finish = solid.copy()
    finish[:-1] &= ~solid[1:] | first[1:]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


def word_hashes(text: pa.Array, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Return the hashes of all words, A-Z lower-cased, and the ``n + 1`` word offsets of the rows."""
    data, offsets = text_bytes(text)
    data = lowered(data)
    starts, ends, bounds = word_spans(data, offsets)
    return span_hashes(data, starts, ends, seed), bounds


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Return the distinct ``width``-word shingles of each row, sorted, with offsets.

    A row of fewer words has one shingle, the whole sequence; a row without
    words has none.
    """
    counts = np.diff(bounds)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(counts)), n)
    if not len(row):
        return np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    at = bounds[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    take = np.minimum(counts[row], width)
    code = np.zeros(len(row), np.uint64)
    for k in range(width):
        inside = take > k
        code[inside] = mix64(code[inside] * np.uint64(BASE) + words[at[inside] + k] + np.uint64(k + 1))
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    return code[new], np.searchsorted(row[new], np.arange(len(counts) + 1))
