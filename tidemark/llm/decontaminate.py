"""Benchmark leaks, also re-parameterised ones, by template windows.

Texts become templates: numbers, names and units give way to typed
placeholders.  Windows of template tokens are hash-joined between benchmark
items and documents; the values that stood in the placeholders must map from
item to document consistently, so that the same question with other values
counts, and a mere likeness of form doesn't.  Beside them, windows of the
words as they stand find verbatim copies, whatever share of them are slots.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch
from tidemark.llm.words import BASE, NOT_ALNUM, lowered, mix64, span_hashes, text_bytes, text_slices

#: Units of measure that stand after a number.
UNITS = "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal s sec secs min mins h hr hrs hour hours day days week weeks month months year years ms hz khz mhz ghz w kw mw v a j kj cal kcal b kb mb gb tb k c f percent pct usd eur gbp dollar dollars cent cents euro euros mph kph meter meters metre metres mile miles foot feet inch inches pound pounds gram grams litre litres liter liters second seconds minute minutes degree degrees".split()
#: Words that open sentences without being names.
OPENERS = "a about after all also an and any are as at because before between both but by calculate can compute consider could did do does each every evaluate explain find first for from given had has have he her his how i if in is it its let list many more most my no not of on one or other our she should show since so some suppose that the their then there these they this those through to two under use was we were what when where which while who whose why will with would write you your".split()
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x6A09E667F3BCC909, 0xBB67AE8584CAA73B, 0x3C6EF372FE94F82B))
_DIGIT = np.array([48 <= b < 58 for b in range(256)])
_UPPER = np.array([65 <= b < 91 for b in range(256)])
_STOP = np.array([chr(b) in ".!?:;\n" for b in range(256)])
#: The share of literal tokens that a template window has at least.
LEAST_LITERAL = 0.3
#: Bits of the filter that documents' windows pass before the join.
FILTER_BITS = 24


@lru_cache(maxsize=2)
def _listed(words: tuple[str, ...]) -> np.ndarray:
    data, offsets = text_bytes(pa.array(words))
    return np.sort(span_hashes(data, offsets[:-1], offsets[1:]))


def _among(values: np.ndarray, words: list[str]) -> np.ndarray:
    known = _listed(tuple(words))
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def templates(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Return template codes, slot values (0 for literal tokens), the ``n + 1`` token offsets of the rows; and word hashes, the words that stand in slots, and word offsets.

    Words are runs of letters or of digits, A-Z lower-cased.  Tokens are words,
    but ``1,234.5`` is one number; a unit is a known word right after a number;
    a name is a capitalised word, or several in a row; at the start of a
    sentence the words of ``OPENERS`` are none.
    """
    raw, offsets = text_bytes(text)
    n = len(text)
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(n + 1, np.int64)
    if not len(raw):
        return none
    data = lowered(raw)
    solid, digit = ~NOT_ALNUM[data], _DIGIT[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    edge = first[1:-1] | (digit[1:] != digit[:-1])
    begin, finish = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge
    finish[:-1] &= ~solid[1:] | edge
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    if not len(starts):
        return none
    value = span_hashes(data, starts, ends)
    doc = np.searchsorted(offsets, starts, "right") - 1
    fresh = np.ones(len(starts), bool)
    fresh[1:] = doc[1:] != doc[:-1]
    stops = np.append(0, np.cumsum(_STOP[data]))
    opening = fresh.copy()
    opening[1:] |= stops[starts[1:]] > stops[ends[:-1]]
    number = digit[starts]
    accented = (raw[starts] == 0xC3) & (np.append(raw, 0)[starts + 1] >= 0x80) & (np.append(raw, 0)[starts + 1] <= 0x9E)
    name = (_UPPER[raw[starts]] | accented) & ~(opening & _among(value, OPENERS)) & ~number
    unit = _among(value, UNITS)
    unit[1:] &= number[:-1] & ~fresh[1:]
    unit[0] = False
    code = np.where(number, NUMBER, np.where(name, NAME, np.where(unit, UNIT, value)))
    gap = np.append(0, starts[1:] - ends[:-1])
    between = np.append(0, data[np.minimum(ends[:-1], len(data) - 1)])
    joined = np.zeros(len(starts), bool)
    joined[1:] = (number[1:] & number[:-1] & ((between[1:] == 44) | (between[1:] == 46)) | name[1:] & name[:-1]) & (gap[1:] == 1) & ~fresh[1:]
    head = np.flatnonzero(~joined)
    slot = np.where(number | name | unit, value, np.uint64(0))
    # A merged slot's value is the sum of its parts' hashes by place.
    place = np.arange(len(starts)) - np.repeat(head, np.diff(np.append(head, len(starts))))
    slot = np.add.reduceat(slot * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)), head)
    # The lowest bit marks a name that opens a sentence: it may be any word, so it says nothing on consistency.
    slot = np.where((number | name | unit)[head], slot & ~np.uint64(1) | (name & opening)[head], np.uint64(0))
    return code[head], slot, np.searchsorted(doc[head], np.arange(n + 1)), value, number | name | unit, np.searchsorted(doc, np.arange(n + 1))


def window_hashes(code: np.ndarray, slot: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Return hash, row and start of all windows of ``width`` tokens of which at least ``LEAST_LITERAL`` are literal."""
    if len(code) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(code) - width + 1
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = mix64(h * np.uint64(BASE) ^ code[k : k + n])
    literal = np.append(0, np.cumsum(slot == 0))
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    at = np.arange(n)
    good = (at + width <= bounds[1:][doc]) & (literal[width:] - literal[:-width] >= LEAST_LITERAL * width)
    at = np.flatnonzero(good)
    return h[at], doc[at], at


def _windows(batches: Iterator[pa.RecordBatch], widths: list[int], longest: int, passing: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Windows of each row; of rows in ``passing`` mode only those whose hash may be a benchmark's.

    A negative width stands for that many words instead of template tokens.
    """
    for batch in batches:
        for part in text_slices(batch, "text"):
            code, slot, bounds, word, slotted, word_bounds = templates(part.column("text"))
            literal = np.append(0, np.cumsum(~slotted))
            for width in widths:
                span, begin = abs(width), bounds if width > 0 else word_bounds
                size = np.diff(begin)
                h, doc, at = window_hashes(code, slot, bounds, width) if width > 0 else window_hashes(word, np.zeros(len(word), np.uint64), word_bounds, span)
                if passing is not None:
                    keep = passing[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
                    h, doc, at = h[keep], doc[keep], at[keep]
                    if width < 0 and span < longest:  # a short item matches whole, so the first place tells all
                        order = np.lexsort((at, h, doc))
                        h, doc, at = h[order], doc[order], at[order]
                        keep = np.ones(len(h), bool)
                        keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                        h, doc, at = h[keep], doc[keep], at[keep]
                elif span < longest:  # a short item is one window
                    keep = size[doc] == span
                    h, doc, at = h[keep], doc[keep], at[keep]
                if not len(h):
                    continue
                held = width if width > 0 else 0  # words are equal as they are, so only template windows bring slots
                slots = slot[at[:, None] + np.arange(held)].view(np.int64) if held else np.zeros(0, np.int64)
                wordy = 2 * (slots == 0).reshape(len(h), -1).sum(axis=1) >= span if width > 0 else 2 * (literal[at + span] - literal[at]) >= span
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(doc)), pa.array(h.view(np.int64)), pa.array(np.full(len(h), width), pa.int32()), pa.array((at - begin[:-1][doc]).astype(np.int32)), pa.array(size[doc].astype(np.int32)), pa.array(wordy), pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1) * held, pa.int32()), pa.array(slots.reshape(-1)))],
                    ["id", "h", "width", "at", "n_tokens", "wordy", "slots"],
                )


_SCHEMA = "id long, h long, width int, at int, n_tokens int, wordy boolean, slots array<long>"


def benchmark_leaks(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", width: int = 10, least_share: float = 0.5, least_tokens: int = 24
) -> DataFrame:
    """Return the (doc_id, item_id) pairs where a document holds a benchmark item or its re-parameterised form.

    Columns: n_tokens (of the item's template), n_covered (of them, by windows
    that match along one alignment), share, verbatim (all slots hold the same
    values) and doc_token (where the match begins).  A pair is reported if its
    slots are consistent and the match covers ``least_share`` of the item or
    ``least_tokens`` tokens.  Items shorter than ``width`` tokens must match
    whole.  Of several alignments the longest counts, then the earliest.

    Template windows count if at least three tenths of their tokens are
    literal; where it is less than half of any, different values must also
    stay different.  What names open sentences may differ freely.  Templates of one or two tokens don't count.  Verbatim copies of whole items,
    one word included, are always found, by their words (runs of letters or of
    digits, case of A-Z apart).  Of partial copies, windows of ``width`` words
    of which less than half are literal count by the same share.  A pair found
    only by words is verbatim, and its n_tokens, n_covered and doc_token count
    words; what template windows and words cover isn't added up.

    Null or empty texts and null ids match nothing; repeated rows give one
    pair.  An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    base = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    every = [*range(3, width + 1), *range(-width, 0)]
    asked = scratch.keep(items.mapInArrow(lambda it: _windows(it, every, width, None), _SCHEMA), "items")
    widths = [r.width for r in asked.select("width").distinct().collect()]  # at most ``2 * width`` values
    # at most 2**FILTER_BITS
    bits = asked.select(
        F.shiftrightunsigned("h", 64 - FILTER_BITS).cast("int").alias("b")
    ).distinct().toPandas()["b"].to_numpy(np.int64)
    passing = np.zeros(1 << FILTER_BITS, bool)
    passing[bits] = True
    packed = np.packbits(passing)
    found = base.mapInArrow(lambda it: _windows(it, widths, width, np.unpackbits(packed).view(bool)), _SCHEMA)
    found = found.select("h", "width", F.col("id").alias("doc_id"), F.col("at").alias("doc_at"), F.col("slots").alias("doc_slots"))
    hits = found.join(asked, ["h", "width"]).select(
        "doc_id", F.col("id").alias("item_id"), "n_tokens", (F.col("width") > 0).alias("template"), F.abs("width").alias("width"),
        "wordy", "at", (F.col("doc_at") - F.col("at")).alias("shift"),
        F.arrays_zip(F.col("slots").alias("b"), F.col("doc_slots").alias("d")).alias("pairs")
    )
    # One alignment of a pair has at most as many windows as the item.
    whole = hits.groupBy("doc_id", "item_id", "n_tokens", "template", "shift").agg(
        F.collect_set(F.struct("at", "width", "wordy")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set(F.filter("pairs", lambda p: p["b"] != 0)))).alias("pairs")
    )
    covered = lambda spans: F.size(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["width"] - 1)))))
    # Of words that aren't the whole item only windows count that no template can match.
    counted = F.when(F.col("template") | (covered("spans") == F.col("n_tokens")), F.col("spans")).otherwise(F.filter("spans", lambda s: ~s["wordy"]))
    whole = whole.withColumn("spans", counted).where(F.size("spans") > 0)
    firm = F.filter("pairs", lambda p: p["b"].bitwiseAND(F.lit(1)) == 0)
    values = lambda side: F.size(F.array_distinct(F.transform("firm", lambda p: p[side])))
    bare = lambda x: F.shiftrightunsigned(x, 1)
    whole = whole.withColumn("firm", firm)
    whole = whole.select(
        "doc_id", "item_id", "n_tokens", "template", covered("spans").alias("n_covered"),
        F.greatest(F.lit(0), F.col("shift") + F.array_min(F.transform("spans", lambda s: s["at"]))).alias("doc_token"),
        F.coalesce(F.forall("pairs", lambda p: bare(p["b"]) == bare(p["d"])), F.lit(True)).alias("verbatim"),
        (
            (F.size("firm") == values("b")) & (F.forall("spans", lambda s: s["wordy"]) | (F.size("firm") == values("d")))
        ).alias("consistent")
    )
    good = whole.where(F.col("consistent") & ((F.col("n_covered") >= least_share * F.col("n_tokens")) | (F.col("n_covered") >= least_tokens)))
    best = good.groupBy("doc_id", "item_id").agg(
        F.max_by(
            F.struct("n_tokens", "n_covered", "verbatim", "doc_token"), F.struct("template", "n_covered", -F.col("doc_token"))
        ).alias("m")
    )
    out = best.select(
        "doc_id", "item_id", "m.n_tokens", "m.n_covered", (F.col("m.n_covered") / F.col("m.n_tokens")).alias("share"),
        "m.verbatim", "m.doc_token"
    )
    return scratch.result(out)
