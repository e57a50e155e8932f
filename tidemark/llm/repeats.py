"""Removal of repeated byte strings over a whole corpus with suffix arrays.

Every string of ``length`` bytes has a content-chosen anchor, the smallest hash
among its ``anchor``-byte grams, so equal strings have equal anchors and meet in
one shard.  A run of strings with one anchor is an extent.  Chunks of documents
first ask which of their anchors others have too; only extents of such anchors
travel.  In a chunk, and then in a shard, extents that are equal byte for byte
collapse into the first of them.  Extents that still share an anchor are sorted
in suffix arrays, block by block; neighbours with a common prefix of ``length``
are occurrences of one string, and blocks that share an anchor are merged by
binary search in the sorted strings of the blocks before.

An anchor with more different extents than a shard should hold is split: its
strings go by their own 128-bit fingerprints, as rows of an ordinary aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import pack_chunks, packed_counts, packed_keys, release, rows_of, runs, unpacked, unpacked_counts, unpacked_keys
from tidemark.llm.scratch import Scratch
from tidemark.llm.words import BASE, equal_spans, lanes, mix64, new_seed, span_hashes

# --- suffix arrays -----------------------------------------------------------


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Return the suffix array of ``data``, by Larsson-Sadakane refinement.

    Suffixes are ordered by their first ``depth`` members at least; the order
    of those that agree in all of them is left open.  ``data`` holds unsigned
    integers; past the end counts as smaller than all.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    bits = (int(data.max()) + 1).bit_length()
    h = max(1, 64 // bits)
    key = np.zeros(n, np.uint64)
    for k in range(h):
        key <<= np.uint64(bits)
        key[: max(0, n - k)] |= data[k:].astype(np.uint64) + np.uint64(1)
    order = np.argsort(key)
    ordered = key[order]
    del key
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    del ordered
    # A group's number is the place of its last member, so that refining it leaves all others alone.
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(head + size - 1, size)
    todo = np.flatnonzero(np.repeat(size > 1, size))
    while len(todo) and h < depth:
        pos = order[todo]
        ahead = pos + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        first = rank[pos]
        turn = np.argsort(first * np.int64(n + 1) + second + 1) if n < 1 << 30 else np.lexsort((second, first))
        pos, first, second = pos[turn], first[turn], second[turn]
        order[todo] = pos
        new = np.ones(len(todo), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(todo)))
        rank[pos] = np.repeat(todo[head + size - 1], size)
        todo = todo[np.repeat(size > 1, size)]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Return the common prefix of each suffix with the one before it, up to ``limit``.

    Kasai's observation, that a suffix shares with its predecessor at least one
    less than the suffix to its left does, makes the shared lengths of
    neighbours in the text overlap; here all positions advance together, and
    of a chain of overlapping ones only the last is compared.
    """
    n = len(order)
    shared = np.zeros(n, np.int64)
    if n < 2:
        return shared
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    plcp = np.zeros(n, np.int64)
    # Chains i, i + 1 with predecessors j, j + 1 hold the same mismatch.
    chained = np.zeros(n, bool)
    chained[:-1] = (before[:-1] >= 0) & (before[1:] == before[:-1] + 1) & (data[:-1] == data[np.maximum(before[:-1], 0)])
    at, k = np.flatnonzero((before >= 0) & ~chained), 0
    while len(at) and k < limit:
        i, j = at + k, before[at] + k
        inside = (i < n) & (j < n)
        same = inside.copy()
        same[inside] = data[i[inside]] == data[j[inside]]
        at = at[same]
        plcp[at] = k + 1
        k += 1
    index = np.arange(n)
    stop = np.where(chained, n, index)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    plcp = np.where(before >= 0, np.minimum(limit, plcp[np.minimum(stop, n - 1)] + stop - index), 0)
    return plcp[order]


def first_occurrences(data: np.ndarray, usable: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Find strings of ``length`` that start at ``usable`` positions and occur at a smaller one.

    Returns a flag for each position, and the first occurrences in the order
    of their strings.
    """
    order = suffix_array(data, length)
    head = np.flatnonzero(common_prefixes(data, order, length) < length)
    n = len(data)
    pos = np.where(usable[order], order, n)
    first = np.minimum.reduceat(pos, head) if n else pos
    repeated = np.zeros(n + 1, bool)
    repeated[pos[pos != np.repeat(first, np.diff(np.append(head, n)))]] = True
    return repeated[:n], first[first < n]


# --- anchors and extents -----------------------------------------------------


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from each position on; ``width`` is 8 times a power of two."""
    code = lanes(data)[: len(data) - 7] * np.uint64(BASE)
    span = 8
    while True:
        code ^= code >> np.uint64(29)
        if span == width:
            return mix64(code)
        code = code[:-span] * np.uint64(0xD1342543DE82EF95) + code[span:]
        span *= 2


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The minimum of every ``span`` neighbours, by doubling."""
    width = 1
    while width < span:
        step = min(width, span - width)
        values = np.minimum(values[:-step], values[step:])
        width += step
    return values


_EXTENT = np.dtype([("low", "<u8"), ("doc", "<i4"), ("start", "<i4"), ("count", "<i4"), ("twice", "?")])


def _slice_extents(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> np.ndarray:
    n = len(data)
    if n < length:
        return np.zeros(0, _EXTENT)
    grams = gram_hashes(data, anchor)
    span = length - anchor + 1
    low = _least(grams, span)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))[: n - length + 1]
    whole = np.arange(n - length + 1, dtype=np.int32) <= (offsets[1:] - length).astype(np.int32)[doc]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | ~whole[:-1]
    new &= whole
    start = np.flatnonzero(new)
    if not len(start):
        return np.zeros(0, _EXTENT)
    total = np.concatenate([[0], np.cumsum(whole)])
    out = np.empty(len(start), _EXTENT)
    out["count"] = np.append(total[start[1:]], total[-1]) - total[start]
    # An extent with two places for its anchor may hold a string twice.
    view, mine = sliding_window_view(grams, span), low[start]
    end = start + out["count"] - 1
    out["twice"] = start + (view[start] == mine[:, None]).argmax(axis=1) != end + span - 1 - (view[end][:, ::-1] == mine[:, None]).argmax(axis=1)
    # Minima are small numbers; mixed, they spread evenly over hash ranges.
    out["low"], out["doc"], out["start"] = mix64(mine), doc[start], start - offsets[:-1][doc[start]]
    return out


def extents(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int, limit: int = 1 << 17) -> np.ndarray:
    """The extents of all documents, in order: anchor, document, start in it, number of strings, and whether one may repeat inside.

    Works on ``limit`` bytes at once, or on one document.
    """
    parts, at, n = [], 0, len(offsets) - 1
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1))
        part = _slice_extents(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], length, anchor)
        part["doc"] += at
        parts.append(part)
        at = to
    return np.concatenate(parts) if parts else np.zeros(0, _EXTENT)


# --- messages between chunks and shards --------------------------------------

_COPY = np.dtype([("doc", "<i4"), ("start", "<i4"), ("count", "<i4")])
_META = np.dtype([("low", "<u8"), ("id", "<i8"), ("doc", "<i4"), ("start", "<i4"), ("count", "<i4"), ("twice", "?")])
_STRING = np.dtype([("f0", "<i8"), ("f1", "<i8"), ("id", "<i8"), ("doc", "<i4"), ("start", "<i4")])
COPY, EXTENTS, STRINGS = 0, 1, 2


def _bytes_of(rows: np.ndarray, data: np.ndarray | None = None) -> bytes:
    """Structured rows, byte by byte, and then plain bytes, compressed."""
    planes = np.ascontiguousarray(rows.view(np.uint8).reshape(-1, rows.dtype.itemsize).T) if len(rows) else np.zeros(0, np.uint8)
    return zstandard.compress(len(rows).to_bytes(8, "little") + planes.tobytes() + (b"" if data is None else data.tobytes()), 3)


def _rows_of_bytes(payload: bytes, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(payload), np.uint8)
    n = int.from_bytes(raw[:8].tobytes(), "little")
    end = 8 + n * dtype.itemsize
    planes = raw[8:end].reshape(dtype.itemsize, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype), raw[end:]


def _structured(dtype: np.dtype, **cols: np.ndarray) -> np.ndarray:
    out = np.empty(len(next(iter(cols.values()))), dtype)
    for k, v in cols.items():
        out[k] = v
    return out


def _batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(schema)], [n for n, _ in schema])


def _groups(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    if len(values):
        edge = np.flatnonzero(np.append(True, values[1:] != values[:-1])).tolist()
        yield from zip(edge, [*edge[1:], len(values)], strict=True)


def _joined(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Runs of strings as copies in order, neighbouring runs as one."""
    order = np.lexsort((start, doc))
    doc, start, count = doc[order], start[order].astype(np.int64), count[order].astype(np.int64)
    if not len(doc):
        return np.zeros(0, _COPY)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + count[:-1])
    head = np.flatnonzero(new)
    return _structured(_COPY, doc=doc[head], start=start[head], count=np.add.reduceat(count, head))


_ASKED = "part int, chunk long, keys binary, kinds binary"
_ASKED_ARROW = [("part", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("kinds", pa.binary())]
_TOLD = "chunk long, part int, n long, keys binary, hot binary"
_TOLD_ARROW = [("chunk", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("hot", pa.binary())]
_SENT = "shard int, chunk long, kind int, payload binary"
_SENT_ARROW = [("shard", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())]
_FOUND = "chunk long, kind int, payload binary"
_FOUND_ARROW = [("chunk", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())]


def _ends(offsets: np.ndarray, found: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    start = offsets[:-1][found["doc"]] + found["start"]
    return start, start + found["count"] + length - 1


def _ask(batches: Iterator[pa.RecordBatch], parts: int, length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """For each chunk and hash range: its distinct anchors, and of how many kinds their extents are."""
    for row in rows_of(batches):
        _, offsets, data = unpacked(row)
        found = extents(data, offsets, length, anchor)
        whole = span_hashes(data, *_ends(offsets, found, length))
        order = np.lexsort((whole, found["low"]))
        low, whole = found["low"][order], whole[order]
        new = np.ones(len(low), bool)
        new[1:] = low[1:] != low[:-1]
        kind = new.copy()
        kind[1:] |= whole[1:] != whole[:-1]
        keys = low[new]
        kinds = np.add.reduceat(kind.astype(np.int64), np.flatnonzero(new)) if len(low) else np.zeros(0, np.int64)
        rows = [(p, row["chunk"], packed_keys(keys[a:b]), packed_counts(kinds[a:b])) for p, a, b in zip(*(x.tolist() for x in runs(keys, parts)), strict=True)]
        if rows:
            yield _batch(_ASKED_ARROW, rows)


def _tell(table: pa.Table, most: int) -> pa.Table:
    """Of a hash range: which of its anchors each chunk shares with others, and which have more than ``most`` kinds."""
    release()
    part, chunks = table.column("part")[0].as_py(), table.column("chunk").to_pylist()
    keys = [unpacked_keys(x.as_py()) for x in table.column("keys")]
    kinds = np.concatenate([unpacked_counts(x.as_py()) for x in table.column("kinds")])
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    shared, hot = np.bincount(at)[at] > 1, np.bincount(at, weights=kinds)[at] > most
    rows, end = [], 0
    for chunk, own in zip(chunks, keys, strict=True):
        mine = slice(end, end + len(own))
        end += len(own)
        some = own[shared[mine]]
        rows.append((chunk, part, len(some), packed_keys(some), packed_keys(own[hot[mine]])))
    return pa.Table.from_batches([_batch(_TOLD_ARROW, rows)])


def _member(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are among sorted keys."""
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values if len(keys) else np.zeros(len(values), bool)


def _copies(data: np.ndarray, start: np.ndarray, end: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For spans in order of precedence: the place of the first span with equal anchor and bytes."""
    code = span_hashes(data, start, end)
    order = np.lexsort((np.arange(len(low)), code, low))
    size, code = (end - start)[order], code[order]
    new = np.ones(len(order), bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (code[1:] != code[:-1]) | (size[1:] != size[:-1])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    same = equal_spans(data, start[order], start[first], size)
    out = np.empty(len(order), np.int64)
    out[order] = np.where(same, first, order)
    return out


def _spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of spans, one after the other."""
    size = end - start
    shift = np.repeat((start - np.append(0, np.cumsum(size)[:-1])).astype(np.int32 if len(data) < 1 << 30 else np.int64), size)
    shift += np.arange(len(shift), dtype=shift.dtype)
    return data[shift]


def _cut(batches: Iterator[pa.RecordBatch], shards: int, length: int, anchor: int, seeds: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Cut the different extents of shared anchors out of the texts, and deal them out by anchor; copies inside the chunk go to shard -1 - k."""
    for row in rows_of(batches):
        ids, offsets, data = unpacked(row)
        told = sorted(row["told"] or [], key=lambda x: x["part"])
        shared, hot = (np.concatenate([unpacked_keys(x[c]) for x in told]) if told else np.zeros(0, np.uint64) for c in ("keys", "hot"))
        found = extents(data, offsets, length, anchor)
        uniq, times = np.unique(found["low"], return_counts=True)
        several = np.union1d(uniq[times > 1], found["low"][found["twice"]])
        found = found[_member(found["low"], np.union1d(shared, several))]
        # In order of precedence: by id, then place.
        found = found[np.lexsort((found["start"], found["doc"], ids[found["doc"]]))]
        start, end = _ends(offsets, found, length)
        first = _copies(data, start, end, found["low"])
        copy = first != np.arange(len(first))
        apart = -1 - int(row["chunk"]) % shards
        rows = []
        if copy.any():
            rows.append((apart, row["chunk"], COPY, _bytes_of(_joined(found["doc"][copy], found["start"][copy], found["count"][copy]))))
        found, start, end = found[~copy], start[~copy], end[~copy]
        uniq, times = np.unique(found["low"], return_counts=True)
        keep = _member(found["low"], np.union1d(shared, uniq[times > 1])) | found["twice"]
        split = _member(found["low"], hot) & keep
        if split.any():
            for a in range(0, int(split.sum()), 4096):
                rows.append((apart, row["chunk"], STRINGS, _bytes_of(_strings_of(data, ids, found[split][a : a + 4096], start[split][a : a + 4096], length, seeds))))
        keep &= ~split
        found, start, end = found[keep], start[keep], end[keep]
        shard = (found["low"] % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        begin = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(order)], strict=False):
            mine, s = order[a:b], int(shard[order[a]])
            some = found[mine]
            meta = _structured(_META, low=some["low"], id=ids[some["doc"]], doc=some["doc"], start=some["start"], count=some["count"], twice=some["twice"])
            rows.append((s, row["chunk"], EXTENTS, _bytes_of(meta, _spans(data, start[mine], end[mine]))))
        for a in range(0, len(rows), 64):
            yield _batch(_SENT_ARROW, rows[a : a + 64])
        release()


def _strings_of(data: np.ndarray, ids: np.ndarray, found: np.ndarray, start: np.ndarray, length: int, seeds: tuple[int, int]) -> np.ndarray:
    """Fingerprints of all strings of the extents, with their places."""
    n = found["count"].astype(np.int64)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at, doc = np.repeat(start, n) + inside, np.repeat(found["doc"], n)
    prints = [span_hashes(data, at, at + length, seed).view(np.int64) for seed in seeds]
    return _structured(_STRING, f0=prints[0], f1=prints[1], id=ids[doc], doc=doc, start=np.repeat(found["start"], n) + inside)


# --- shards ------------------------------------------------------------------


def _sorted_block(meta: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Sort the strings of extents: flags, first occurrences, and each position's extent and offset."""
    size = meta["count"].astype(np.int64) + length - 1
    ext = np.repeat(np.arange(len(meta), dtype=np.int32), size + 1)
    begin = np.append(0, np.cumsum(size + 1))[:-1]
    text = np.zeros(len(ext), np.uint16)
    inner = np.ones(len(ext), bool)
    inner[begin + size] = False
    text[inner] = data.astype(np.uint16) + 1  # 0 parts the extents
    offset = (np.arange(len(ext)) - begin[ext]).astype(np.int32)
    repeated, first = first_occurrences(text, offset < meta["count"][ext], length)
    return repeated, first, ext, offset


def _blocks(meta: np.ndarray, data: np.ndarray, length: int, limit: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Cut extents in anchor order into blocks of about ``limit`` bytes; an anchor with more than that spans several."""
    size = meta["count"].astype(np.int64) + length - 1
    total, low, at = np.append(0, np.cumsum(size)), meta["low"], 0
    while at < len(meta):
        to = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
        if to < len(meta) and low[to] == low[to - 1]:  # end at an anchor's edge, unless one anchor fills the block
            edge = int(np.searchsorted(low, low[to], "left"))
            to = edge if edge > at else to
        yield slice(at, to), data[total[at] : total[to]]
        at = to


def _fixed(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The strings at some places as fixed-width ones whose order is that of the bytes."""
    out = np.ones((len(at), length + 1), np.uint8)
    if len(at):
        out[:, :length] = sliding_window_view(data, length)[at]
    return out.view(f"S{length + 1}").ravel()


def _shard_copies(meta: np.ndarray, chunk: np.ndarray, data: np.ndarray, length: int, limit: int) -> tuple[np.ndarray, ...]:
    """Repeated strings among the extents of a shard, as (chunk, doc, start, count)."""
    size = meta["count"].astype(np.int64) + length - 1
    end = np.cumsum(size)
    order = np.lexsort((meta["start"], meta["doc"], chunk, meta["id"], meta["low"]))
    meta, chunk, start, end = meta[order], chunk[order], (end - size)[order], end[order]
    first = _copies(data, start, end, meta["low"])
    copy = first != np.arange(len(first))
    out = [(chunk[copy], meta["doc"][copy], meta["start"][copy], meta["count"][copy])]
    # Several kinds of one anchor, or one that may repeat inside, are sorted.
    _, at = np.unique(meta["low"], return_inverse=True)
    sort = ~copy & ((np.bincount(at, weights=~copy)[at] > 1) | meta["twice"])
    meta, chunk = meta[sort], chunk[sort]
    data = _spans(data, start[sort], end[sort])
    held: list[np.ndarray] = []
    last = None
    for block, own in _blocks(meta, data, length, limit):
        some = meta[block]
        repeated, found, ext, offset = _sorted_block(some, own, length)
        begin = np.append(0, np.cumsum(some["count"].astype(np.int64) + length - 1))[:-1]
        if last != some["low"][0]:
            held = []
        if held:
            mine = found[some["low"][ext[found]] == some["low"][0]]
            text = _fixed(own, begin[ext[mine]] + offset[mine], length)
            for older in held:  # an older block's string is the earlier one
                place = np.minimum(np.searchsorted(older, text), len(older) - 1)
                hit = older[place] == text
                repeated[mine[hit]] = True
                mine, text = mine[~hit], text[~hit]
        tail = int(some["low"][-1])
        if tail != some["low"][0]:
            held = []
        if block.stop < len(meta) and meta["low"][block.stop] == some["low"][-1]:
            mine = found[(some["low"][ext[found]] == some["low"][-1]) & ~repeated[found]]
            if len(mine):
                held.append(_fixed(own, begin[ext[mine]] + offset[mine], length))
        last = some["low"][-1]
        at = np.flatnonzero(repeated)
        if len(at):
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (ext[at[1:]] != ext[at[:-1]])
            head = np.flatnonzero(new)
            e = ext[at[head]]
            out.append((chunk[block][e], some["doc"][e], some["start"][e] + offset[at[head]], np.diff(np.append(head, len(at)))))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _by_chunk(chunk: np.ndarray, doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.Table:
    """Copies as one row for each chunk."""
    order = np.argsort(chunk, kind="stable")
    chunk, doc, start, count = chunk[order], doc[order], start[order], count[order]
    return pa.Table.from_batches(
        [
            _batch(
                _FOUND_ARROW,
                [(int(chunk[a]), COPY, _bytes_of(_joined(doc[a:b], start[a:b], count[a:b]))) for a, b in _groups(chunk)]
            )
        ]
    )


def _shard(table: pa.Table, length: int, limit: int) -> pa.Table:
    """The copies of a shard; what was found before passes through."""
    release()
    if table.column("shard")[0].as_py() < 0:
        return table.select(["chunk", "kind", "payload"])
    parts = [_rows_of_bytes(x.as_py(), _META) for x in table.column("payload")]
    chunk = np.repeat(table.column("chunk").to_numpy(), [len(m) for m, _ in parts])
    meta, data = np.concatenate([m for m, _ in parts]), np.concatenate([d for _, d in parts])
    del parts
    return _by_chunk(*_shard_copies(meta, chunk, data, length, limit))


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each fingerprinted string."""
    for row in rows_of(batches):
        found, _ = _rows_of_bytes(row["payload"], _STRING)
        for a in range(0, len(found), 1 << 16):
            some = found[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), row["chunk"], np.int64)),
                    *(pa.array(np.ascontiguousarray(some[n])) for n in _STRING.names)
                ],
                ["chunk", *_STRING.names]
            )


def _split_copies(strings: DataFrame) -> DataFrame:
    """Copies among fingerprinted strings: all but the first of each."""
    rows = strings.mapInArrow(_exploded, "chunk long, f0 long, f1 long, id long, doc int, start int")
    place = F.struct("id", "chunk", "doc", "start")
    first = rows.groupBy("f0", "f1").agg(F.min(place).alias("m"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = rows.join(first, ["f0", "f1"]).where(place != F.col("m")).select("chunk", "doc", "start")

    def packed(table: pa.Table) -> pa.Table:
        chunk, doc, start = (table.column(n).to_numpy() for n in ("chunk", "doc", "start"))
        return _by_chunk(chunk, doc, start, np.ones(len(doc), np.int64))

    return copies.groupBy("chunk").applyInArrow(packed, _FOUND)


def _removed(batches: Iterator[pa.RecordBatch], length: int, whole_chars: bool) -> Iterator[pa.RecordBatch]:
    """Apply the removals to the texts of each chunk."""
    for row in rows_of(batches):
        ids, offsets, data = unpacked(row)
        delta = np.zeros(len(data) + 1, np.int32)
        for payload in row["copy"] or []:
            found, _ = _rows_of_bytes(payload, _COPY)
            start, end = _ends(offsets, found, length)
            np.add.at(delta, start, 1)
            np.add.at(delta, end, -1)
        gone = np.cumsum(delta[:-1], dtype=np.int32) > 0
        if whole_chars and gone.any():  # a character stays if one of its bytes does
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            size = np.diff(np.append(lead, len(data)))
            gone = np.repeat(np.add.reduceat(gone.astype(np.int32), lead) == size, size)
        first = np.zeros(len(data) + 1, bool)
        first[offsets[:-1]] = True
        head = gone & (~np.append(False, gone[:-1]) | first[:-1]) if len(gone) else gone
        total, spans = np.append(0, np.cumsum(gone)), np.append(0, np.cumsum(head))
        n_removed, n_spans = total[offsets[1:]] - total[offsets[:-1]], spans[offsets[1:]] - spans[offsets[:-1]]
        kept = [data[a:b][~gone[a:b]].tobytes() if r else data[a:b].tobytes() for a, b, r in zip(offsets[:-1], offsets[1:], n_removed, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(np.diff(offsets)), pa.array(n_removed), pa.array(n_spans), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array([k if r else None for k, r in zip(kept, n_removed.tolist(), strict=True)], pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def repeated_bytes(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100, anchor: int = 32,
    whole_chars: bool = False, with_text: bool = False, chunk_bytes: int = 1 << 20, part_bytes: int = 32 << 20,
    shard_bytes: int = 4 << 20, block_bytes: int = 1 << 19, most_kinds: int = 16_384
) -> DataFrame:
    """Return doc_id, n_bytes, n_removed, n_spans and kept_sha256 for each document.

    A byte is removed if a ``length``-byte string that covers it also starts
    earlier: in a document of smaller id, or before it in the same document.
    Strings are judged on the input.  With ``with_text`` a column ``kept`` has
    the bytes left where something was removed (else null), and with
    ``whole_chars`` a UTF-8 character goes only if all its bytes do.

    Chunks have ``chunk_bytes`` of text or one document; hash ranges answer for
    about ``part_bytes`` of text, shards hold about ``shard_bytes`` of extents
    and sort ``block_bytes`` at once.  Strings of anchors with more than
    ``most_kinds`` different extents are compared by 128-bit
    fingerprints under seeds drawn for the run.

    A null text is empty; texts shorter than ``length`` lose nothing.  Rows
    with a null id keep all their bytes and take no part in the search.  Rows
    that repeat an id are separate texts whose order is left open.  Other
    columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chunks = scratch.keep(pack_chunks(base.where("id is not null"), chunk_bytes), "chunks")
    size = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    parts = max(8, -(-size // part_bytes))
    asked = chunks.mapInArrow(lambda it: _ask(it, parts, length, anchor), _ASKED)
    told = scratch.keep(asked.groupBy("part").applyInArrow(lambda t: _tell(t, most_kinds), _TOLD), "told")
    shared = told.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # An extent has some 30 strings, and of ``length`` bytes one less than that more.
    shards = max(8, -(-shared * (length + 30) // shard_bytes))
    answers = told.groupBy("chunk").agg(F.collect_list(F.struct("part", "keys", "hot")).alias("told"))
    seeds = new_seed(), new_seed()
    sent = chunks.join(answers, "chunk").mapInArrow(lambda it: _cut(it, shards, length, anchor, seeds), _SENT)
    found = scratch.keep(sent.groupBy("shard").applyInArrow(lambda t: _shard(t, length, block_bytes), _FOUND), "found")
    copies = found.where(F.col("kind") == COPY)
    split = found.where(F.col("kind") == STRINGS)
    if split.limit(1).count():
        copies = copies.union(_split_copies(split))
    copies = copies.groupBy("chunk").agg(F.collect_list("payload").alias("copy"))
    out = chunks.join(copies, "chunk", "left").mapInArrow(
        lambda it: _removed(it, length, whole_chars),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    lost = base.where("id is null").select(
        F.col("id").alias("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), F.lit(None).cast("binary").alias("kept")
    )
    out = out.unionByName(lost)
    return scratch.result(out if with_text else out.drop("kept"))
