"""GIF media columns: a writer, a full decoder, and colour-histogram features.

The decoder reads any GIF87a/89a: LZW code streams of 2 to 12 bits, global and
local palettes, interlacing, transparency and the disposal methods.  The writer
stores 8-bit samples as frames of one size, coded by a growing table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch
from tidemark.session import ship

SIDE = 24
FRAME = SIDE * SIDE


def palette() -> np.ndarray:
    """256 distinct colours: three bits of red and green, two of blue, each spread over 0 to 255."""
    i = np.arange(256)
    return np.stack([(i >> 5) * 255 // 7, (i >> 2 & 7) * 255 // 7, (i & 3) * 255 // 3], axis=1).astype(np.uint8)


# --- LZW ---------------------------------------------------------------------


def _widths(min_bits: int, n: int) -> np.ndarray:
    """The widths of the first ``n`` codes after a clear code: the table gains an entry with each code but the first."""
    entries = (1 << min_bits) + 2 + np.maximum(0, np.arange(n) - 1)
    return np.minimum(12, np.frexp(entries.astype(np.float64))[1]).astype(np.int64)


def lzw_codes(samples: bytes, min_bits: int) -> list[list[int]]:
    """The codes of samples by the longest entries of a growing table; a list for each table, as a full one is cleared."""
    free = start = (1 << min_bits) + 2
    parts, out, table, word = [], [], {}, -1
    find, put = table.get, out.append
    for b in samples:
        if word < 0:
            word = b
            continue
        longer = word << 8 | b
        found = find(longer)
        if found is not None:
            word = found
            continue
        put(word)
        word = b
        if free < 4096:
            table[longer] = free
            free += 1
        else:
            parts.append(out)
            out, table, free = [], {}, start
            find, put = table.get, out.append
    if word >= 0:
        put(word)
    parts.append(out)
    return parts


def lzw_encode_all(many: list[bytes], min_bits: int = 8) -> list[bytes]:
    """The code streams of some runs of samples, with clear codes first and after each full table, and an end code."""
    clear = 1 << min_bits
    codes, places, sizes = [], [], []
    for samples in many:
        own, place = [clear], [-1]
        parts = lzw_codes(samples, min_bits)
        for k, part in enumerate(parts):
            own += part
            own.append(clear + 1 if k == len(parts) - 1 else clear)
            place += range(len(part) + 1)
        codes += own
        places += place
        sizes.append(len(own))
    if not many:
        return []
    code, place, size = np.array(codes, np.uint32), np.array(places, np.int64), np.array(sizes, np.int64)
    width = np.append(_widths(min_bits, int(place.max()) + 1), min_bits + 1)[place]  # the first clear code has place -1
    # Each stream starts at a byte of its own.
    total = np.append(0, np.cumsum(width))
    head = np.cumsum(size) - size
    bits = total[head + size] - total[head]
    length = (bits + 7) // 8
    begin = np.append(0, np.cumsum(length))
    at = total[:-1] + np.repeat(begin[:-1] * 8 - total[head], size)
    out = np.zeros(begin[-1] + 3, np.uint8)
    byte, value = at >> 3, code << (at & 7).astype(np.uint32)
    # Codes of 9 bits and more begin in bytes of their own, so no step below meets a byte twice.
    for k in range(3):
        part = (value >> np.uint32(8 * k) & np.uint32(255)).astype(np.uint8)
        if min_bits >= 8:
            out[byte + k] |= part
        else:
            np.bitwise_or.at(out, byte + k, part)
    raw = out.tobytes()
    return [raw[a:b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


def lzw_decode_all(streams: list[bytes], min_bits: int) -> list[bytes | None]:
    """Decode LZW code streams; one cut short gives what it has, one with a code beyond its table None.

    All streams go forward together, from one clear code to the next.  A code's
    string is that of an earlier code and the byte after it, so its length is
    the depth of a chain of codes, and each of its bytes stands earlier in the
    output; both chains are followed by doubling.
    """
    if not 2 <= min_bits <= 11:
        raise ValueError("LZW codes start with 2 to 11 bits")
    clear, first = 1 << min_bits, (1 << min_bits) + 2
    size = np.array([len(s) for s in streams], np.int64)
    base = np.cumsum(size) - size
    raw = np.frombuffer(b"".join(streams) + b"\0\0\0\0", np.uint8)
    words = np.ndarray((len(raw) - 3,), "<u4", raw, strides=(1,))
    at, stop = base * 8, (base + size) * 8
    # Most streams begin with a clear code.
    opening = (stop - at > min_bits) & ((words[np.minimum(at >> 3, len(words) - 1)] & np.uint32(2 * clear - 1)) == clear)
    at[opening] += min_bits + 1
    parts: list[list[bytes] | None] = [[] for _ in streams]
    live, most = np.arange(len(streams)), 5000
    while len(live):
        widths = _widths(min_bits, most)
        ends = np.cumsum(widths)
        n = np.searchsorted(ends, stop[live] - at[live], "right")
        head = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(head, n)
        bit = np.repeat(at[live], n) + ends[place] - widths[place]
        code = (words[bit >> 3] >> (bit & 7).astype(np.uint32) & ((1 << widths[place]) - 1).astype(np.uint32)).astype(np.int64)
        # A table ends with the first clear or end code.
        marks = np.flatnonzero((code == clear) | (code == clear + 1))
        mark = np.searchsorted(marks, head)
        found = np.append(marks, len(code))[mark]
        stopped = found < head + n
        last = np.where(stopped, found - head, n)
        if (~stopped & (n == most)).any():
            most *= 8
            continue
        for f, text in zip(live.tolist(), _strings(code, place, head, last, clear, first), strict=True):
            if text is None or parts[f] is None:
                parts[f] = None
            elif text:
                parts[f].append(text)
        again = stopped & (np.append(code, -1)[found] == clear)
        step = ends[np.minimum(last, most - 1)]
        live, step = live[again], step[again]
        at[live] += step
    return [None if p is None else p[0] if len(p) == 1 else b"".join(p) for p in parts]


def _strings(code: np.ndarray, place: np.ndarray, head: np.ndarray, last: np.ndarray, clear: int, first: int) -> list[bytes | None]:
    """The output of some streams' codes, each from an empty table on; ``last`` codes of each count."""
    keep = place < np.repeat(last, np.diff(np.append(head, len(code))))
    code, place = code[keep], place[keep]
    head = np.cumsum(last) - last
    n = len(code)
    stream = np.repeat(np.arange(len(last)), last)
    literal = code < clear
    back = code - first  # the code whose string and next byte are meant
    wrong = np.bincount(stream[~literal & (back >= place)], minlength=len(last)) > 0
    parent = np.where(literal | wrong[stream], n, np.repeat(head, last) + back)
    # Lengths: one more than the steps to a literal.
    steps, up = np.append((parent < n).astype(np.int64), 0), np.append(parent, n)
    while (up[:-1] < n).any():
        steps[:-1] += steps[up[:-1]]
        up[:-1] = up[up[:-1]]
    size = steps[:-1] + 1
    end = np.cumsum(size)
    begin = end - size
    owner = np.repeat(np.arange(n, dtype=np.int32), size)
    whole = parent[owner] < n
    source = np.arange(len(owner))
    source[whole] += (begin[np.minimum(parent, n - 1)] - begin)[owner[whole]]
    while True:
        further = source[source]
        if (further == source).all():
            break
        source = further
    out = np.where(literal, code, 0).astype(np.uint8)[owner][source].tobytes()
    edge = np.append(begin, len(owner))
    return [None if bad else out[a:b] for bad, a, b in zip(wrong.tolist(), edge[head].tolist(), edge[head + last].tolist(), strict=True)]


# --- container ---------------------------------------------------------------


def _blocked(stream: bytes) -> bytes:
    return b"".join([bytes([len(stream[i : i + 255])]) + stream[i : i + 255] for i in range(0, len(stream), 255)]) + b"\0"


def write_gif(streams: list[bytes], side: int, colours: np.ndarray, delay: int, min_bits: int = 8) -> bytes:
    """Assemble a looping GIF of square frames from their code streams; ``delay`` is in hundredths of a second."""
    head = b"GIF89a" + struct.pack("<HHBBB", side, side, 0xF7, 0, 0) + colours.tobytes() + b"\x21\xff\x0bNETSCAPE2.0\x03\x01\0\0\0"
    control = b"\x21\xf9\x04" + struct.pack("<BHBB", 0x04, delay, 0, 0) + b"\x2c" + struct.pack("<HHHHB", 0, 0, side, side, 0) + bytes([min_bits])
    return head + b"".join([control + _blocked(s) for s in streams]) + b"\x3b"


@dataclass
class Frame:
    """A frame as stored: where it goes, its code stream and how it is shown."""

    left: int
    top: int
    width: int
    height: int
    colours: np.ndarray
    interlaced: bool
    min_bits: int
    stream: bytes
    delay: int = 0
    disposal: int = 0
    transparent: int = -1
    samples: np.ndarray | None = field(default=None, repr=False)


def parse_gif(data: bytes) -> tuple[int, int, list[Frame]]:
    """Return a GIF's width, height and frames, their streams not yet decoded."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    at, shared = 13, np.zeros((0, 3), np.uint8)
    if flags & 0x80:
        n = 2 << (flags & 7)
        shared = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
    frames, shown = [], (0, 0, -1)

    def blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while data[at]:
            parts.append(data[at + 1 : at + 1 + data[at]])
            at += 1 + data[at]
        return b"".join(parts), at + 1

    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            kind = data[at + 1]
            body, at = blocks(at + 2)
            if kind == 0xF9:
                f, delay, index = struct.unpack("<BHB", body[:4])
                shown = (delay, f >> 2 & 7, index if f & 1 else -1)
        elif data[at] == 0x2C:
            left, top, w, h, f = struct.unpack_from("<HHHHB", data, at + 1)
            at += 10
            colours = shared
            if f & 0x80:
                n = 2 << (f & 7)
                colours = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
                at += 3 * n
            min_bits = data[at]
            stream, at = blocks(at + 1)
            frames.append(Frame(left, top, w, h, colours, bool(f & 0x40), min_bits, stream, *shown))
            shown = (0, 0, -1)
        else:
            raise ValueError("unknown GIF block")
    return width, height, frames


def _rows_in_order(samples: np.ndarray) -> np.ndarray:
    """Undo interlacing: every 8th row from 0, every 8th from 4, every 4th from 2, every 2nd from 1."""
    h = len(samples)
    out = np.empty_like(samples)
    out[np.concatenate([np.arange(0, h, 8), np.arange(4, h, 8), np.arange(2, h, 4), np.arange(1, h, 2)])] = samples
    return out


def decode_frames(frames: list[Frame]) -> None:
    """Decode the streams of all frames into (height, width) samples; a damaged stream leaves None."""
    for bits in {f.min_bits for f in frames}:
        some = [f for f in frames if f.min_bits == bits]
        for f, got in zip(some, lzw_decode_all([f.stream for f in some], bits), strict=True):
            if got is not None:
                size = f.width * f.height
                flat = np.frombuffer(got[:size].ljust(size, b"\0"), np.uint8).reshape(f.height, f.width)
                f.samples = _rows_in_order(flat) if f.interlaced else flat


def compose(width: int, height: int, frames: list[Frame]) -> Iterator[tuple[np.ndarray, int]]:
    """Yield each shown picture as (height, width) RGBA integers, red lowest, and its delay, after transparency and disposal.

    The picture is good until the next one is asked for.
    """
    canvas = np.zeros((height, width), np.uint32)
    made: dict[int, np.ndarray] = {}
    for f in frames:
        before = canvas.copy() if f.disposal == 3 else None
        place = canvas[f.top : f.top + f.height, f.left : f.left + f.width]
        samples = f.samples[: place.shape[0], : place.shape[1]]
        colours = made.get(id(f.colours))
        if colours is None:
            made.clear()
            rgba = np.zeros((256, 4), np.uint8)
            rgba[: len(f.colours), :3] = f.colours
            rgba[:, 3] = 255
            colours = made[id(f.colours)] = rgba.view("<u4").ravel()
        np.copyto(place, colours[samples], where=samples != f.transparent)
        yield canvas, f.delay
        if f.disposal == 2:
            place[:] = 0
        elif f.disposal == 3:
            canvas = before


def colour_histogram(picture: np.ndarray) -> np.ndarray:
    """Pixels in 64 bins, by the upper two bits of red, green and blue."""
    p = picture.ravel()
    return np.bincount((p >> 2 & 48 | p >> 12 & 12 | p >> 22 & 3).astype(np.int64), minlength=64)


# --- columns -----------------------------------------------------------------


def _encode(batches: Iterator[pa.RecordBatch], delay: int) -> Iterator[pa.RecordBatch]:
    colours = palette()
    for batch in batches:
        at = 0
        while at < batch.num_rows:  # about a megabyte at once
            to, payloads, size = at, [], 0
            while to < batch.num_rows and (size < 1 << 20 or to == at):
                raw = batch.column("text")[to].as_py().encode()
                payloads.append(raw + b"\xff" * ((-len(raw)) % FRAME or (0 if raw else FRAME)))
                size += len(payloads[-1])
                to += 1
            streams = lzw_encode_all([p[a : a + FRAME] for p in payloads for a in range(0, len(p), FRAME)])
            media, k = [], 0
            for p in payloads:
                n = len(p) // FRAME
                media.append(write_gif(streams[k : k + n], SIDE, colours, delay))
                k += n
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(at, to - at), batch.column("n_bytes").slice(at, to - at), pa.array(media, pa.binary())],
                ["id", "n_bytes", "media"]
            )
            at = to


def encode_gifs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", delay: int = 10) -> DataFrame:
    """Return (id, n_bytes, media): each text's UTF-8, padded with 255, as a GIF of 24 x 24 frames.

    A null text is empty and makes one frame of padding; ids may be null or
    repeat.
    """
    ship(docs.sparkSession)
    base = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return base.mapInArrow(lambda it: _encode(it, delay), "id long, n_bytes long, media binary")


DAMAGED = (ValueError, IndexError, struct.error)


def _read(media: bytes | None) -> tuple[int, int, list[Frame], str | None]:
    """A GIF's size and frames, not yet decoded, or what is wrong with it."""
    if media is None:
        return 0, 0, [], "no media"
    try:
        return *parse_gif(media), None
    except DAMAGED as e:
        return 0, 0, [], str(e) or "cut short"


def _figures(media: bytes, width: int, height: int, frames: list[Frame]) -> tuple:
    payload = b"".join([f.samples.tobytes() for f in frames])
    total, duration = np.zeros(64, np.int64), 0
    for picture, delay in compose(width, height, frames):
        total += colour_histogram(picture)
        duration += delay
    shown = " ".join(f"{b}:{n}" for b, n in enumerate(total.tolist()) if n)
    feature = f"{width}x{height} frames={len(frames)} ms={10 * duration} colours={shown}"
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(frames), None


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames", "error"]
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string())
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            to, media, size = at, [], 0
            while to < batch.num_rows and (size < 1 << 20 or to == at):
                media.append(batch.column("media")[to].as_py())
                size += len(media[-1] or b"")
                to += 1
            parsed = [_read(m) for m in media]
            decode_frames([f for _, _, frames, _ in parsed for f in frames])
            rows = []
            for m, (w, h, frames, error) in zip(media, parsed, strict=True):
                if error is None and any(f.samples is None for f in frames):
                    error = "damaged code stream"
                rows.append(_figures(m, w, h, frames) if error is None else (*[None] * 7, error))
            cols = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(at, to - at), batch.column("n_bytes").slice(at, to - at),
                    *(pa.array(c, t) for c, t in zip(cols, types, strict=True))
                ],
                names
            )
            at = to


def gif_features(media: DataFrame) -> DataFrame:
    """Decode the ``media`` of (id, n_bytes, media) and return what its bytes hold.

    ``payload`` figures are of all frames' samples in order.  ``feature`` has
    the size, number of frames, duration and the histogram over 64 colours of
    all shown pictures, after palettes, transparency and disposal.
    """
    found = media.mapInArrow(
        _features,
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames int, error string"
    )
    return Scratch(media.sparkSession, "gif").result(found)


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
    for batch in batches:
        for doc, media in zip(batch.column("id").to_pylist(), batch.column("media"), strict=True):
            w, h, frames, _ = _read(media.as_py())
            decode_frames(frames)
            at, rows = 0, []
            if all(f.samples is not None for f in frames):
                for k, (picture, d) in enumerate(compose(w, h, frames)):
                    rows.append((doc, k, 10 * at, 10 * d, w, h, picture.tobytes(), colour_histogram(picture).tolist()))
                    at += d
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, types, strict=True)],
                ["id", "frame", "start_ms", "ms", "width", "height", "rgba", "histogram"]
            )


def gif_frames(media: DataFrame) -> DataFrame:
    """Return the timed pictures of each GIF in (id, media), composed, with their colour histograms; null and damaged ones have none."""
    ship(media.sparkSession)
    return media.select("id", "media").mapInArrow(
        _exploded, "id long, frame int, start_ms long, ms long, width int, height int, rgba binary, histogram array<long>"
    )
