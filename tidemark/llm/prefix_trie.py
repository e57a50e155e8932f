"""The trie of conversation prefixes: who shares which turns, and what caching them would save.

A node is a distinct sequence of first turns, named by a SHA-256 digest that
depends on that sequence alone, so that conversations meet in their nodes by
equal digests and a node's digest and its parent's are an edge.  Sums over
subtrees take one round for each doubling of the distance that they reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

#: Turns of one conversation that one task chains; longer conversations are chained in levels of blocks.
FAN = 4096
ROOT = hashlib.sha256(b"root").digest()
#: Bytes of identifiers in one row on their way to a node's hash.
BLOB = 1 << 18

_PLACED = pa.schema([("conv", pa.int64()), ("local", pa.int64()), ("part", pa.int32()), ("leaf", pa.binary()), ("n_bytes", pa.int64())])
_CHAINED = pa.schema([("conv", pa.int64()), ("pos", pa.int64()), ("digest", pa.binary()), ("parent", pa.binary()), ("n_bytes", pa.int64())])
_BLOBS = pa.schema([("digest", pa.binary()), ("first", pa.int64()), ("blob", pa.binary())])
_HASHES = pa.schema([("digest", pa.binary()), ("ends_sha256", pa.string())])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each conversation within a sorted partition, from 1."""
    from pyspark import TaskContext

    part, last, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column("conv").to_numpy()
        new = np.ones(n, bool)
        new[1:] = conv[1:] != conv[:-1]
        new[0] = conv[0] != last
        begins = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        local = np.where(begins >= 0, np.arange(n) - begins + 1, at + np.arange(n) + 1)
        last, at = conv[-1], int(local[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(local), pa.array(np.full(n, part, np.int32)), batch.column("leaf"), batch.column("n_bytes")], schema=_PLACED
        )


def numbered_turns(
    turns: DataFrame, scratch: Scratch, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Return (conv, pos, leaf, n_bytes) for each turn: its place in its conversation from 1, its digest, its text's UTF-8 bytes.

    A null turn comes first; equal turns follow each other by the digest of
    role and text.  A null role or text is empty.  Each row is a turn, repeated
    ones too; rows without a conversation are left out.  Places come from ranges
    of all turns, so that no conversation has to fit a task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    leaf = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    base = turns.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), leaf.alias("leaf"), F.octet_length(text).cast("long").alias("n_bytes")
    ).where("conv is not null")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("leaf"), F.col("at")]
    dealt = base.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = scratch.keep(
        dealt.select("conv", "leaf", "n_bytes").mapInArrow(_placed, "conv long, local long, part int, leaf binary, n_bytes long"), "placed"
    )
    runs = placed.groupBy("conv", "part").agg(F.max("local").alias("n"))
    # Rows before those of a partition; only the first conversation of a partition has some, so there are fewer than partitions.
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    later = runs.withColumn("before", before).where("before > 0").drop("n")
    pos = F.col("local") + F.coalesce("before", F.lit(0))
    return placed.join(F.broadcast(later), ["conv", "part"], "left").select("conv", pos.alias("pos"), "leaf", "n_bytes")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the digests of sorted blocks; a mark gives the digest of a block's start or end, if there are blocks before."""
    sha, key, state, forced = hashlib.sha256, None, ROOT, None
    for batch in batches:
        digests, parents, keep = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("conv", "block", "pos", "mark", "first", "leaf"))
        for i, (conv, block, pos, mark, first, leaf) in enumerate(zip(*columns, strict=True)):
            if key != (conv, block):
                key, state, forced = (conv, block), ROOT, None
            if mark:
                if pos == first:
                    state = leaf
                else:
                    forced = leaf
                continue
            parents.append(state)
            state = forced or sha(state + leaf).digest()
            digests.append(state)
            keep.append(i)
        if keep:
            at = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv").take(at), batch.column("pos").take(at), pa.array(digests, pa.binary()), pa.array(parents, pa.binary()), batch.column("n_bytes").take(at)],
                schema=_CHAINED
            )


def _blocks(level: DataFrame, fan: int) -> DataFrame:
    """Turns or blocks with the block that each belongs to, and the place before that block."""
    block = F.expr(f"(pos - 1) div {fan}")
    return level.select("conv", block.alias("block"), "pos", F.lit(False).alias("mark"), (block * fan).alias("first"), "leaf", "n_bytes")


def _chain(rows: DataFrame) -> DataFrame:
    dealt = rows.repartition("conv", "block").sortWithinPartitions("conv", "block", "pos", F.desc("mark"))
    return dealt.mapInArrow(_chained, "conv long, pos long, digest binary, parent binary, n_bytes long")


def prefix_digests(turns: DataFrame, scratch: Scratch, fan: int = FAN) -> DataFrame:
    """Return (conv, pos, digest, parent, n_bytes): the digest of every prefix of every conversation, and of the prefix one turn shorter.

    A prefix's digest is that of the one before and of its last turn.  At
    every ``fan`` turns it is that of the blocks before it instead, which are
    chained in the same way, so that a task never chains more than ``fan`` turns.
    """
    levels, longest = [turns], turns.agg(F.max("pos")).first()[0] or 0
    while longest > fan:
        whole = _chain(_blocks(levels[-1], fan)).where(F.col("pos") % fan == 0)
        up = whole.select("conv", (F.col("pos") / fan).cast("long").alias("pos"), F.col("digest").alias("leaf"), F.lit(0).cast("long").alias("n_bytes"))
        levels.append(scratch.keep(up, f"level{len(levels)}"))
        longest //= fan
    found = None
    for k, level in reversed(list(enumerate(levels))):
        rows = _blocks(level, fan)
        if found is not None:
            # Each prefix of blocks starts the block after it and ends the one before.
            given = F.unhex(F.sha2(F.concat(F.lit(b"blocks"), F.col("digest")), 256))
            sides = F.explode(F.array(F.col("pos"), F.col("pos") - 1))
            marks = found.select("conv", sides.alias("block"), (F.col("pos") * fan).alias("pos"), F.lit(True).alias("mark"), given.alias("leaf"))
            rows = rows.unionByName(marks.withColumn("first", F.col("block") * fan).withColumn("n_bytes", F.lit(0).cast("long")))
        found = scratch.keep(_chain(rows), f"prefixes{k}")
    return found


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the sorted identifiers of each digest by commas, up to ``BLOB`` bytes or the partition's end."""
    held: list[str] = []
    size, key, first, out = 0, None, 0, []

    def flush() -> None:
        if held:
            out.append({"digest": key, "first": first, "blob": ",".join(held).encode()})
            held.clear()

    for batch in batches:
        for digest, conv in zip(batch.column("digest").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if digest != key or size >= BLOB:
                flush()
                key, first, size = digest, conv, 0
            held.append(str(conv))
            size += len(held[-1]) + 1
        if len(out) > 1000 or size >= BLOB:
            yield pa.RecordBatch.from_pylist(out, _BLOBS)
            out.clear()
    flush()
    yield pa.RecordBatch.from_pylist(out, _BLOBS)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash the blobs of each digest in their order, with commas between."""
    key, state = None, hashlib.sha256()
    for batch in batches:
        out = []
        for digest, blob in zip(batch.column("digest").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            if digest != key:
                if key is not None:
                    out.append({"digest": key, "ends_sha256": state.hexdigest()})
                key, state = digest, hashlib.sha256(blob)
            else:
                state.update(b",")
                state.update(blob)
        yield pa.RecordBatch.from_pylist(out, _HASHES)
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"digest": key, "ends_sha256": state.hexdigest()}], _HASHES)


def id_list_hashes(ends: DataFrame) -> DataFrame:
    """Return (digest, ends_sha256): SHA-256 of the comma-joined ids (digest, conv) of each digest in ascending order.

    Ranges of all ids make the pieces, so one digest's ids never meet in a
    task; only the hash itself runs over a digest's pieces one after another.
    """
    dealt = ends.repartitionByRange("digest", "conv").sortWithinPartitions("digest", "conv")
    blobs = dealt.select("digest", "conv").mapInArrow(_blobs, "digest binary, first long, blob binary")
    return blobs.repartition("digest").sortWithinPartitions("digest", "first").drop("first").mapInArrow(_hashed, "digest binary, ends_sha256 string")


def rolled_up(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Sum ``n_leaves`` and ``saved_tokens`` over subtrees by pointer jumping; also return ``parent_conv_id``.

    ``nodes`` has digest, parent (null at the root), depth, conv_id and the
    two values.  After round k a node holds the sum over its descendants less
    than 2**k away and points to its ancestor 2**k away; it then adds what
    those hold that point to it, and points where the one it points to points.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    state = nodes.select("digest", "depth", "conv_id", F.col("parent").alias("jump"), F.lit(None).cast("long").alias("parent_conv_id"), "n_leaves", "saved_tokens")
    k = 0
    while 1 << k <= deepest:
        reach = 1 << k
        add = state.where(f"depth >= {reach}").groupBy(F.col("jump").alias("digest")).agg(F.sum("n_leaves").alias("more"), F.sum("saved_tokens").alias("saved"))
        # Nodes whose next pointer would leave the tree look themselves up, so that no key is common but by its descendants.
        far = F.col("depth") >= 2 * reach
        told = state.select(F.col("digest").alias("key"), F.col("jump").alias("next"), F.col("conv_id").alias("up"))
        summed = state.join(add, "digest", "left").withColumn("key", F.when(far, F.col("jump")).otherwise(F.col("digest")))
        state = summed.join(told, "key", "left").select(
            "digest", "depth", "conv_id", F.when(far, F.col("next")).alias("jump"),
            (F.when(far, F.col("up")) if k == 0 else F.col("parent_conv_id")).alias("parent_conv_id"),
            (F.col("n_leaves") + F.coalesce("more", F.lit(0))).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("saved", F.lit(0))).alias("saved_tokens")
        )
        state = scratch.keep(state, f"round{k}")
        if k:
            scratch.drop(f"round{k - 1}")
        k += 1
    return state


def prefix_trie(turns: DataFrame, conversations: DataFrame, scratch: Scratch, fan: int = FAN) -> DataFrame:
    """Return a row for each node of the prefix trie of all conversations.

    ``turns`` has conv, pos (gapless from 1 in each conversation), leaf and
    n_bytes, as ``numbered_turns`` makes them; ``conversations`` lists every
    conv once, with or without turns.  A node has digest, conv_id (smallest
    member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves (childless nodes of its subtree, itself included), saved_tokens
    (over its subtree, (n_convs - 1) times the bytes of the last text) and
    ends_sha256 (of the ids that end there).  Equal turns of several
    conversations are one node, however many there are.  Without
    conversations there is no node, not even the root.
    """
    spark = turns.sparkSession
    turns, conversations = scratch.keep(turns, "turns"), scratch.keep(conversations.select("conv"), "conversations")
    prefixes = prefix_digests(turns, scratch, fan)
    least, count = conversations.agg(F.min("conv"), F.count("*")).first()
    root = spark.createDataFrame([(ROOT, None, least, 0, count, 0)] if count else [], "digest binary, parent binary, conv_id long, depth long, n_convs long, n_bytes long")
    nodes = prefixes.groupBy("digest").agg(
        F.min("parent").alias("parent"), F.min("conv").alias("conv_id"), F.min("pos").alias("depth"), F.count("*").alias("n_convs"),
        F.min("n_bytes").alias("n_bytes")
    ).unionByName(root)
    nodes = scratch.keep(nodes, "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("digest")).agg(F.count("*").alias("n_children"))
    nodes = scratch.keep(
        nodes.join(children, "digest", "left").select(
            "digest", "parent", "conv_id", "depth", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.col("n_children").isNull().cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens")
        ), "families"
    )
    sums = rolled_up(nodes, scratch).select("digest", "parent_conv_id", "n_leaves", "saved_tokens")
    last = prefixes.groupBy("conv").agg(F.max_by("digest", "pos").alias("digest"))
    ends = conversations.join(last, "conv", "left").select("conv", F.coalesce("digest", F.lit(ROOT)).alias("digest"))
    ended = id_list_hashes(ends)
    found = nodes.drop("n_leaves", "saved_tokens").join(sums, "digest").join(ended, "digest", "left")
    return scratch.result(
        found.select(
            "digest", "conv_id", "depth", F.when(F.col("depth") == 1, F.lit(least)).otherwise(F.col("parent_conv_id")).cast("long").alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
        )
    )


def spliced(turns: DataFrame, scratch: Scratch, *, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Rebuild conversations on shared openings; return the turns and the list of conversations for ``prefix_trie``.

    Conversation c opens with the first h turns of conversation c - c % group
    (all if it has fewer, none if there is none), h being crc32 of c in
    decimals modulo most + 1; its own turns after its first h follow.  ``turns``
    comes from ``numbered_turns``, written.  Negative ids take the remainder's sign
    from the id, as SQL does.
    """
    opening = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    heads = turns.where(f"pos <= {most} and conv % {group} = 0").withColumnRenamed("conv", "base")
    convs = turns.where("pos = 1").select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), opening.alias("h"))
    opened = convs.join(heads, "base").where("pos <= h").select("conv", "pos", "leaf", "n_bytes")
    there = heads.groupBy("base").agg(F.count("*").alias("there"))
    short = convs.join(there, "base", "left").select("conv", (F.col("h") - F.coalesce("there", F.lit(0))).alias("gap")).where("gap > 0")
    short = scratch.keep(short, "short")  # so that a long conversation is a skewed join that Spark can split
    own = turns.where(F.col("pos") > opening).join(short, "conv", "left")
    own = own.select("conv", (F.col("pos") - F.coalesce("gap", F.lit(0))).alias("pos"), "leaf", "n_bytes")
    return opened.unionByName(own), convs.select("conv")


def spliced_trie(conversations: DataFrame, fan: int = FAN) -> DataFrame:
    """``prefix_trie`` of the ``spliced`` conversations of (conv_id, turn, role, text)."""
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = scratch.keep(numbered_turns(conversations, scratch), "numbered")
    return prefix_trie(*spliced(turns, scratch), scratch, fan)
