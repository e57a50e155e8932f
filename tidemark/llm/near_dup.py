"""Near-duplicate classes by fast similarity sketches, banding and exact checks.

A sketch has ``t`` coordinates.  In round ``i`` every shingle is hashed to one
bin and a value; a bin keeps its smallest (round, value).  Rounds repeat until
all bins are full; after ``t`` of them a shingle also goes to bin ``i - t``
whatever its hash, so every coordinate fills.  Sketches agree in a coordinate
with probability close to the Jaccard similarity, and they concentrate as if
the coordinates were independent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import release
from tidemark.llm.graph import connected_components
from tidemark.llm.rows import numbered, repeating
from tidemark.llm.scratch import Scratch
from tidemark.llm.words import MIX_A, mix64, new_seed, shingle_hashes, text_slices, word_hashes

_VALUE = np.uint64((1 << 48) - 1)
_EMPTY = np.uint64((1 << 64) - 1)


def sketch(codes: np.ndarray, offsets: np.ndarray, t: int) -> np.ndarray:
    """Return the (rows, t) sketches of sets of hashes; rows of empty sets stay unfilled."""
    n = len(offsets) - 1
    out = np.full((n, t), _EMPTY, np.uint64)
    flat = out.reshape(-1)
    row = np.repeat(np.arange(n), np.diff(offsets))
    open_rows = np.diff(offsets) > 0
    for i in range(2 * t):
        if not len(codes):
            break
        h = mix64(codes ^ mix64(np.array([i + 1], np.uint64)))
        value = (np.uint64(i) << np.uint64(48)) | (h & _VALUE)
        bins = ((h >> np.uint64(48)) * np.uint64(t) >> np.uint64(16)).astype(np.int64) if i < t else np.full(len(h), i - t)
        np.minimum.at(flat, row * t + bins, value)
        still = open_rows & (out == _EMPTY).any(axis=1)
        if still.sum() < open_rows.sum():
            keep = still[row]
            codes, row, open_rows = codes[keep], row[keep], still
    return out


def band_keys(sketches: np.ndarray, bands: int) -> np.ndarray:
    """Return a (rows, bands) array of hashed bands; the band's number is part of the hash."""
    n, t = sketches.shape
    parts = sketches.reshape(n, bands, t // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * MIX_A, (n, bands)).copy()
    for k in range(t // bands):
        key = mix64(key ^ parts[:, :, k])
    return key


#: Coordinates whose lowest bit is kept, to compare sketches in few bytes.
SKETCH_BITS = 384
_WORDS = SKETCH_BITS // 64


def low_bits(sketches: np.ndarray) -> np.ndarray:
    """Return the lowest bit of the first ``SKETCH_BITS`` coordinates, packed into 64-bit integers."""
    bits = np.packbits((sketches[:, :SKETCH_BITS] & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view(np.int64)


def most_differing(percent: int) -> int:
    """Bits in which a pair at the limit differs at most, six standard deviations out (1e-8)."""
    differ = (1 - percent / 100) / 2
    return int(SKETCH_BITS * differ + 6 * (SKETCH_BITS * differ * (1 - differ)) ** 0.5) + 1


def _sketched(batches: Iterator[pa.RecordBatch], width: int, bands: int, rows: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Of each row: its set's size and 128-bit digest, its bands, and its sketch's lowest bits."""
    for batch in batches:
        for part in text_slices(batch, "text", 2 << 20):
            codes, offsets = shingle_hashes(*word_hashes(part.column("text"), seed), width)
            size = np.diff(offsets)
            made = sketch(codes, offsets, bands * rows + 1)
            keys, bits = band_keys(made[:, : bands * rows], bands), low_bits(made)
            raw = memoryview(codes.tobytes())
            digest = np.frombuffer(
                b"".join(
                    [
                        hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(
                            offsets[:-1].tolist(), offsets[1:].tolist(), strict=True
                        )
                    ]
                ),
                np.int64
            ).reshape(-1, 2)
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(size) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1).view(np.int64))
                ) for x in (keys, bits)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(size), *(pa.array(np.ascontiguousarray(digest[:, k])) for k in (0, 1)), *lists],
                ["row", "n", "d0", "d1", "bands", "bits"]
            )
        release()


def _verified(batches: Iterator[pa.RecordBatch], width: int, percent: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Members whose whole sets are similar enough to the pivot's, which stands before them."""
    held_key, held = None, np.zeros(0, np.uint64)
    for batch in batches:
        for part in text_slices(batch, "text", 1 << 20):
            codes, offsets = shingle_hashes(*word_hashes(part.column("text"), seed), width)
            pivot, b = (part.column(n).to_numpy(zero_copy_only=False) for n in ("pivot", "b"))
            key = list(zip(part.column("a").to_pylist(), part.column("salt").to_pylist(), strict=True))
            # Set 0 is the pivot that an earlier slice ended with.
            sets = np.concatenate([held, codes])
            begin = np.concatenate([[0], offsets[:-1] + len(held)])
            size = np.concatenate([[len(held)], np.diff(offsets)])
            is_pivot = np.concatenate([[True], pivot])
            mine = np.maximum.accumulate(np.where(is_pivot, np.arange(len(is_pivot)), 0))
            members = np.flatnonzero(~is_pivot)
            own = mine[members]
            keys = [held_key, *key]
            known = np.array([keys[p] == keys[m] for p, m in zip(own.tolist(), members.tolist(), strict=True)], bool)
            if not known.all():
                raise ValueError("a member came before its pivot")
            common = _common(sets, begin[members], size[members], begin[own], size[own])
            similar = (common > 0) & (100 * common >= percent * (size[members] + size[own] - common))
            at = members[similar] - 1
            yield pa.RecordBatch.from_arrays([part.column("a").take(pa.array(at)), pa.array(b[at])], ["a", "b"])
            last = int(mine[-1])
            if last:
                held_key, held = keys[last], sets[begin[last] : begin[last] + size[last]].copy()
        release()


def _common(sets: np.ndarray, a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The number of codes that each pair of sets, given by places and sizes, has in common."""
    def taken(at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return sets[np.repeat(at - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())]

    if not len(a):
        return np.zeros(0, np.int64)
    row = np.concatenate([np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)])
    code = np.concatenate([taken(a, na), taken(b, nb)])
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    return np.bincount(row[1:][(row[1:] == row[:-1]) & (code[1:] == code[:-1])], minlength=len(a))


def _likely(batches: Iterator[pa.RecordBatch], percent: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Members of a bucket whose sketch is near that of a member of another component."""
    held: list[pa.RecordBatch] = []

    def told(table: pa.Table) -> pa.RecordBatch:
        col = {n: table.column(n).to_numpy() for n in ("key", "i", "j", "x", "row", "n", "c")}
        bits = table.column("bits").combine_chunks().flatten().to_numpy().reshape(-1, _WORDS).view(np.uint64)
        hit = _near(col, bits, percent, limit)
        return pa.RecordBatch.from_arrays([pa.array(col["key"][hit]), pa.array(col["row"][hit])], ["key", "row"])

    group = lambda batch, k: tuple(batch.column(n)[k].as_py() for n in ("key", "i", "j"))
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if group(batch, 0) == group(batch, batch.num_rows - 1):
            continue  # the group may go on
        table = pa.Table.from_batches(held)
        last = group(batch, batch.num_rows - 1)
        at = batch.num_rows - 1
        while group(batch, at - 1) == last:
            at -= 1
        done = table.num_rows - (batch.num_rows - at)
        yield told(table.slice(0, done))
        held = [batch.slice(at)]
    if held:
        yield told(pa.Table.from_batches(held))


def _near(col: dict[str, np.ndarray], bits: np.ndarray, percent: int, limit: int) -> np.ndarray:
    n, c, x = col["n"], col["c"], col["x"]
    new = np.ones(len(n), bool)
    new[1:] = (col["key"][1:] != col["key"][:-1]) | (col["i"][1:] != col["i"][:-1]) | (col["j"][1:] != col["j"][:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(n)))
    end = np.repeat(head + size, size)
    across = col["i"] != col["j"]
    hit = np.zeros(len(n), bool)

    def compare(p: np.ndarray, q: np.ndarray) -> None:
        ok = (c[p] != c[q]) & ~(across[p] & (x[p] == x[q])) & (100 * np.minimum(n[p], n[q]) >= percent * np.maximum(n[p], n[q]))
        p, q = p[ok], q[ok]
        ok = np.bitwise_count(bits[p] ^ bits[q]).sum(axis=1, dtype=np.int64) <= limit
        hit[p[ok]] = True
        hit[q[ok]] = True

    at, d = np.flatnonzero(np.repeat(size <= 64, size)), 1
    while len(at):
        at = at[at + d < end[at]]
        compare(at, at + d)
        d += 1
    for a, m in zip(head[size > 64].tolist(), size[size > 64].tolist(), strict=True):
        for p in range(a, a + m):
            compare(np.full(a + m - p - 1, p), np.arange(p + 1, a + m))
    return np.flatnonzero(hit)


def _sets(batches: Iterator[pa.RecordBatch], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            codes, offsets = shingle_hashes(*word_hashes(part.column("text"), seed), width)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    pa.array([codes[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
                ],
                ["row", "codes"]
            )


def _home_links(table: pa.Table, percent: int) -> pa.Table:
    """Compare members that share a bucket and are in different components, on whole sets.

    Returns links that join components, at most one fewer than there are.
    """
    ids, c = table.column("row").to_numpy(), table.column("c").to_numpy()
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("codes")]
    size = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.append(0, np.cumsum(size))
    keys = table.column("keys").combine_chunks()
    _, key = np.unique(keys.flatten().to_numpy(), return_inverse=True)
    bounds = np.append(0, np.cumsum(keys.value_lengths().to_numpy()))
    member = np.repeat(np.arange(len(ids)), np.diff(bounds))
    by_key = member[np.argsort(key, kind="stable")]
    key_at = np.append(0, np.cumsum(np.bincount(key)))
    _, part, members = np.unique(c, return_inverse=True, return_counts=True)
    out: list[tuple[int, int]] = []
    flags = np.zeros(len(code), np.int32)
    # Members of the largest component are only compared against.
    for y in np.flatnonzero(part != members.argmax()).tolist():
        near = np.unique(np.concatenate([by_key[key_at[k] : key_at[k + 1]] for k in key[bounds[y] : bounds[y + 1]]]))
        near = near[part[near] != part[y]]
        if not len(near):
            continue
        own = code[begin[y] : begin[y + 1]]
        flags[own] = 1
        n = size[near]
        at = np.repeat(begin[near] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        common = np.add.reduceat(flags[code[at]], np.append(0, np.cumsum(n)[:-1]))
        flags[own] = 0
        for x in near[100 * common >= percent * (n + size[y] - common)].tolist():
            if part[x] != part[y]:
                out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                part[part == part[x]] = part[y]
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, bands: int = 57,
    rows: int = 7, block_rows: int = 4096, block_shingles: int = 2_000_000, most_broadcast: int = 1_000_000
) -> DataFrame:
    """Return doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Two documents are linked if ``100 * common >= percent * union`` of their
    sets of ``width``-word shingles; ``component_id`` is the smallest id
    reachable.  A pair at similarity 0.8 escapes all 57 bands of 7 with a
    probability of 1.5e-6; every link is confirmed on the whole sets, of 64-bit
    codes of the shingles under a seed drawn for the run.

    Sets with one 128-bit digest collapse first.  Each member of a bucket is
    compared with the likeliest of its buckets' first members, if sizes and
    sketches allow it, to six standard deviations.  Then components are merged.
    In buckets that still hold several, sketches of members of different
    components are compared, in blocks of ``block_rows``, and the whole sets of
    those with a likely partner, in blocks of ``block_shingles``; of the links
    found only those that join components are kept.  Lists of at most
    ``most_broadcast`` row numbers, counted before, pick texts without a shuffle.

    A null or empty text has no shingles and no links (its component is
    itself).  Rows that repeat an id are one node and all come back.  A null id
    gets a null component and is not kept.  Other columns are ignored.
    """
    scratch, seed = Scratch(docs.sparkSession, "near-dup"), new_seed()
    known = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    repeats = repeating(known, "id", nulls=False)
    base = numbered(known, "id", "text", scratch, "row") if repeats else known.withColumn("row", F.col("id"))
    made = base.where("id is not null").select("row", "text").mapInArrow(
        lambda it: _sketched(it, width, bands, rows, seed), "row long, n long, d0 long, d1 long, bands array<long>, bits array<long>"
    )
    made = scratch.keep(made, "sketches")
    full = made.where("n > 0")
    classes = scratch.keep(full.groupBy("d0", "d1").agg(F.min("row").alias("rep")), "classes")
    heads = scratch.keep(full.join(classes.select(F.col("rep").alias("row")), "row").select("row", "n", "bands", "bits"), "heads")
    keyed = heads.select("row", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high").select("key", "low")
    buckets = scratch.keep(keyed.join(shared, "key"), "buckets")
    sketches = heads.select("row", "n", "bits")
    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    limit = most_differing(percent)

    def picked(wanted: DataFrame, n: int) -> DataFrame:
        """The texts of the rows in ``wanted``, with its other columns."""
        return base.select("row", "text").join(F.broadcast(wanted) if n <= most_broadcast else wanted, "row")

    def check(pairs: DataFrame) -> DataFrame:
        """Confirm pairs of a pivot ``a`` and a member ``b``, each member once, on whole texts."""
        pairs = scratch.keep(pairs, "pairs")
        n = pairs.count()
        sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / 256).cast("int").alias("blocks"))
        dealt = pairs.join(sizes, "a").select(F.col("b").alias("row"), "a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("salt"))
        members = picked(dealt, n).select("a", "salt", F.lit(False).alias("pivot"), F.col("row").alias("b"), "text")
        firsts = picked(sizes.withColumnRenamed("a", "row"), n).select(
            F.col("row").alias("a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("salt"),
            F.lit(True).alias("pivot"), F.col("row").alias("b"), "text"
        )
        sorted_rows = members.union(firsts).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("pivot").desc())
        return scratch.keep(sorted_rows.mapInArrow(lambda it: _verified(it, width, percent, seed), "a long, b long"), "links")

    stars = buckets.where("row > low").select(F.col("low").alias("a"), F.col("row").alias("b")).distinct()
    stars = stars.join(
        sketches.select(F.col("row").alias("a"), F.col("n").alias("m"), F.col("bits").alias("bits_a")), "a"
    ).join(sketches.withColumnRenamed("row", "b"), "b").where(fits)
    off = " + ".join(f"bit_count(bits[{i}] ^ bits_a[{i}])" for i in range(_WORDS))
    stars = stars.withColumn("off", F.expr(off)).where(F.col("off") <= limit)
    links = check(stars.groupBy("b").agg(F.min(F.struct("off", "a")).alias("m")).select(F.col("m.a").alias("a"), "b"))
    parts = connected_components(links, scratch)
    placed = buckets.join(parts.withColumnRenamed("id", "row"), "row", "left").select("key", "row", F.coalesce("component", "row").alias("c"))
    split = placed.groupBy("key").agg(
        F.min("c").alias("low"), F.max("c").alias("high"), F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")
    ).where("low < high").select("key", "blocks")
    rest = scratch.keep(placed.join(split, "key").join(sketches, "row"), "open")
    blocked = rest.withColumn("x", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocked = blocked.select("key", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "x", "row", "n", "c", "bits")
    near = blocked.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(lambda it: _likely(it, percent, limit), "key long, row long")
    likely = scratch.keep(near.distinct(), "likely")
    if likely.limit(1).count():
        members = rest.select("key", "row", "n", "c").join(likely, ["key", "row"])
        # Buckets go where their largest component is at home, so that a member's set travels once or twice and not with each bucket.
        home = members.groupBy("key", "c").agg(F.count("*").alias("k")).groupBy("key").agg(F.max(F.struct("k", "c"))["c"].alias("home"))
        held = scratch.keep(
            members.join(home, "key").groupBy("home", "row").agg(
                F.min("c").alias("c"), F.max("n").alias("n"), F.collect_set("key").alias("keys")
            ),
            "homes"
        )
        sizes = held.groupBy("home").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("blocks"))
        # A home too large for one task is cut into blocks, each compared with each.
        dealt = held.join(sizes, "home").withColumn(
            "x", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
        ).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("home", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "row", "c", "keys")
        wanted = held.select("row").distinct()
        sets = picked(wanted, held.count()).mapInArrow(lambda it: _sets(it, width, seed), "row long, codes binary")
        found = scratch.keep(
            dealt.join(sets, "row").groupBy("home", "i", "j").applyInArrow(
                lambda t: _home_links(t, percent), "a long, b long"
            ).distinct(),
            "links"
        )
        if found.limit(1).count():
            parts = connected_components(links.union(found), scratch)
    low = classes.join(parts.withColumnRenamed("id", "rep"), "rep", "left").select("d0", "d1", F.coalesce("component", "rep").alias("component"))
    out = made.join(low, ["d0", "d1"], "left").select(
        "row", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", "row")).otherwise(F.col("row")).alias("component")
    )
    if repeats:
        out = _by_id(out, base, scratch)
    else:
        out = out.select(F.col("row").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
    lost = known.where("id is null").select("text").mapInArrow(lambda it: _sizes(it, width, seed), "n_shingles long").select(
        F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id")
    )
    out = out.unionByName(lost)
    return scratch.result(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def _sizes(batches: Iterator[pa.RecordBatch], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(shingle_hashes(*word_hashes(part.column("text"), seed), width)[1]))], ["n_shingles"])


def _by_id(out: DataFrame, base: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows that repeat an id are one node: join the components of their rows, and name them by ids."""
    ids = base.where("id is not null").select("row", "id")
    named = scratch.keep(out.join(ids, "row"), "named")
    least = named.groupBy("component").agg(F.min("id").alias("least"))
    named = named.join(least, "component")
    parts = connected_components(named.select(F.col("id").alias("a"), F.col("least").alias("b")), scratch)
    named = named.join(parts.withColumnRenamed("component", "root"), "id", "left")
    return named.select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("root", "least").alias("component_id"))
