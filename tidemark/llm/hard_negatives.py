"""Exact search for positives and hard negatives through inverted lists.

K-means centroids, fitted on a bounded sample, part all vectors into lists, and
each list stores its radius: the largest distance of a member from the centroid.
By Cauchy and Schwarz no member's inner product with a query q is further from
that of the centroid than |q| times the radius.  Queries visit lists from the
highest bound down, skip those whose scores all lie outside their windows, and
stop where the bound falls strictly below their k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import numbered, repeating
from tidemark.llm.scratch import Scratch

#: Rows that the centroids are fitted on at most, those with the smallest hashes.
MOST_SAMPLE = 20_000
MOST_LISTS = 1024
#: Rows that a task scores at once; larger lists are dealt out in blocks of about so many.
BLOCK = 2048
#: Queries that a task scores at once.
QUERIES = 256
#: Lists that queries have visited after each round.
ROUNDS = (16, 256, MOST_LISTS)
#: Components are held within these bounds, so that scores fit 64 bits.
LIMIT = 1 << 26
#: Products of norms below this are exact sums of doubles.
EXACT = float(1 << 52)

_ROWS = "list int, row long, id long, label string, vec binary, far double"
_PLAN = "list int, block int, query long, label string, vec binary, lows array<long>, highs array<long>"
_HITS = "query long, win int, score long, id long, row long"


@dataclass
class Lists:
    """Centroids, and for each list its radius and number of blocks."""

    centroids: np.ndarray
    radius: np.ndarray
    blocks: np.ndarray


def fitted(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """K-means centroids of the rows of ``sample`` by Lloyd's iterations; at most as many as there are different rows."""
    sample = np.unique(sample, axis=0).astype(np.float64)
    if len(sample) <= k:
        return sample
    centroids = sample[np.random.default_rng(seed).choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        near = nearest(sample, centroids)
        size = np.bincount(near, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        centroids = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centroids)
    return centroids


def nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(1) - 2 * (rows @ centroids.T), axis=1)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Packed vectors as rows of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), width).astype(np.float64)


def _packed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Vectors as 32-bit integers, shorter ones filled up with zeros."""
    for batch in batches:
        vecs = batch.column("vec")
        size = np.diff(vecs.offsets.to_numpy())
        out = np.zeros((len(vecs), width), "<i4")
        out[np.repeat(np.arange(len(vecs)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = vecs.flatten().to_numpy()
        packed = pa.array([r.tobytes() for r in out], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("vec"), "vec", packed)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The list of each row, and its distance from the centroid."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            rows = matrix(part.column("vec"), centroids.shape[1])
            near = nearest(rows, centroids)
            far = np.sqrt(((rows - centroids[near]) ** 2).sum(1))
            cols = [pa.array(near.astype(np.int32)), *(part.column(c) for c in ("row", "id", "label", "vec")), pa.array(far)]
            yield pa.RecordBatch.from_arrays(cols, ["list", "row", "id", "label", "vec", "far"])


def _planned(batches: Iterator[pa.RecordBatch], lists: Lists, begin: int, end: int) -> Iterator[pa.RecordBatch]:
    """For each query the blocks of those lists, of ranks from ``begin`` to ``end`` by upper bound, that can still change its results."""
    for batch in batches:
        for at in range(0, batch.num_rows, QUERIES):
            part = batch.slice(at, QUERIES)
            q = matrix(part.column("vec"), lists.centroids.shape[1])
            mid = q @ lists.centroids.T
            slack = np.sqrt((q**2).sum(1))[:, None] * lists.radius
            slack = slack * (1 + 1e-9) + 1e-6 + 1e-9 * np.abs(mid)
            lows, highs = part.column("lows").to_pylist(), part.column("highs").to_pylist()
            rank = np.argsort(np.argsort(-(mid + slack), axis=1, kind="stable"), axis=1)
            which, where, block = [], [], []
            for i in range(part.num_rows):
                up, down = mid[i] + slack[i], mid[i] - slack[i]
                wanted = np.zeros(len(up), bool)
                for low, high in zip(lows[i], highs[i], strict=True):
                    wanted |= (up >= low) & (down <= high) & (low <= high)
                for n in np.flatnonzero(wanted & (rank[i] >= begin) & (rank[i] < end)).tolist():
                    b = int(lists.blocks[n])
                    which += [i] * b
                    where += [n] * b
                    block += range(b)
            taken = part.take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int32()), pa.array(block, pa.int32()), *(taken.column(c) for c in ("query", "label", "vec", "lows", "highs"))],
                ["list", "block", "query", "label", "vec", "lows", "highs"]
            )


def best_of_rows(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` highest allowed integer scores of each row, of equal ones the leftmost."""
    n = scores.shape[1]
    if np.abs(scores).max(initial=0) >= (1 << 62) // max(n, 1):
        scores = np.unique(scores, return_inverse=True)[1].reshape(scores.shape)
    key = np.where(allowed, scores.astype(np.int64) * n + np.arange(n - 1, -1, -1), np.iinfo(np.int64).min)
    if n <= k:
        return np.nonzero(allowed)
    top = np.argpartition(key, n - k, axis=1)[:, n - k :]
    some = np.take_along_axis(allowed, top, axis=1)
    return np.nonzero(some)[0], top[some]


def _scored(batches: Iterator[pa.RecordBatch], width: int, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """The best rows of each block for each query and window; a block's rows come before its queries."""
    key: tuple | None = None
    held: list[pa.RecordBatch] = []
    block: tuple | None = None

    def answered(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, ids, nums, labels, codes = block
        q = matrix(part.column("vec"), width)
        if np.sqrt((q**2).sum(1).max(initial=0) * (rows**2).sum(1).max(initial=0)) < EXACT:
            scores = (q @ rows.T).astype(np.int64)
        else:
            scores = q.astype(np.int64) @ rows.astype(np.int64).T
        query = part.column("query").to_numpy()
        alike = np.array([codes.get(x, -1) for x in part.column("label").to_pylist()])[:, None] == labels
        allowed = (alike & (query[:, None] != nums[None, :])) if same else ~alike
        lows, highs = part.column("lows").to_pylist(), part.column("highs").to_pylist()
        for w in range(max(map(len, lows), default=0)):
            low = np.array([x[w] if len(x) > w else 1 for x in lows])[:, None]
            high = np.array([x[w] if len(x) > w else 0 for x in highs])[:, None]
            i, j = best_of_rows(scores, allowed & (scores >= low) & (scores <= high), k)
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query[i]), pa.array(np.full(len(i), w, np.int32)), pa.array(scores[i, j]), pa.array(ids[j]), pa.array(nums[j])],
                    ["query", "win", "score", "id", "row"]
                )

    for batch in batches:
        where = np.stack([batch.column(c).to_numpy() for c in ("list", "block", "ask")])
        cuts = np.flatnonzero((np.diff(where) != 0).any(0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if a == b:
                continue
            lst, blk, ask = where[:, a].tolist()
            part = batch.slice(a, b - a)
            if (lst, blk) != key:
                key, held, block = (lst, blk), [], None
            if not ask:
                held.append(part)
                continue
            if block is None and held:
                whole = pa.Table.from_batches(held).combine_chunks()
                ids, nums = whole.column("id").to_numpy(), whole.column("row").to_numpy()
                order = np.lexsort((nums, ids))
                labels = whole.column("label").to_pylist()
                codes = {x: i for i, x in enumerate(set(labels))}
                block = matrix(whole.column("vec"), width)[order], ids[order], nums[order], np.array([codes[x] for x in labels])[order], codes
            for at in range(0, part.num_rows, QUERIES) if block else ():
                yield from answered(part.slice(at, QUERIES))


def _search(queries: DataFrame, rows: DataFrame, lists: Lists, k: int, same: bool, scratch: Scratch, name: str) -> DataFrame:
    """The ``k`` best rows of each (query, window): higher scores first, then smaller id, then smaller row.

    ``same`` takes rows of the query's label other than itself, else rows of
    other labels.  Two or three rounds visit more and more lists; each plans by
    the k-th scores that the rounds before have found.
    """
    spark, width = queries.sparkSession, lists.centroids.shape[1]
    found = spark.createDataFrame([], _HITS)
    order = Window.partitionBy("query", "win").orderBy(F.desc("score"), "id", "row")
    begin = 0
    for end in ROUNDS:
        if begin >= len(lists.radius):
            break
        kth = found.groupBy("query", "win").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
        kth = kth.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("win", "kth"))).alias("kth"))  # one entry a window
        asked = queries.join(kth, "query", "left").withColumn("lows", F.transform("lows", lambda x, i: F.greatest(x, F.col("kth")[i]))).drop("kth")
        plan = asked.select("query", "label", "vec", "lows", "highs").mapInArrow(lambda it, a=begin, b=end: _planned(it, lists, a, b), _PLAN)
        none = F.lit(None).cast("long")
        both = rows.select("list", "block", F.lit(0).alias("ask"), none.alias("query"), "label", "vec", F.lit(None).cast("array<long>").alias("lows"), F.lit(None).cast("array<long>").alias("highs"), "id", "row")
        both = both.unionByName(plan.withColumn("ask", F.lit(1)).withColumn("id", none).withColumn("row", none))
        dealt = both.repartition("list", "block").sortWithinPartitions("list", "block", "ask")
        hits = dealt.mapInArrow(lambda it: _scored(it, width, k, same), _HITS)
        best = found.unionByName(hits).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")
        found = scratch.keep(best, f"{name}{end}")
        begin = end
    return found


def _whole(a: F.Column, b: int, up: bool) -> F.Column:
    """a / b rounded down or up, exactly."""
    b_ = F.lit(b).cast("long")
    top = a + F.pmod(-a, b_) if up else a - F.pmod(a, b_)
    return (top / b_).cast("long") if b == 1 else F.call_function("div", top, b_)


def mine_hard_negatives(
    items: DataFrame, *, id_col: str = "id", label_col: str = "label", vec_col: str = "vec", anchor_col: str = "anchor", positives: int = 5,
    negatives: int = 5, low_percent: int = 80, high_percent: int = 100
) -> DataFrame:
    """For each anchor and each of its positives the hardest negatives in a window below the positive's score.

    ``items`` has ids, labels, vectors of integers and a flag for anchors.  An
    anchor's positives are the ``positives`` other rows of its label with the
    highest inner products; a positive of score p has as negatives the
    ``negatives`` best rows of other labels with a score s such that
    low_percent * p <= 100 * s <= high_percent * p.  Ties go by smaller id.  Results are
    exact.

    Rows with a null id, label, vector or component take no part.  Rows alike
    in id, label and vector count once; others that share an id are rows of
    their own.  Shorter vectors end in zeros, empty ones score 0; components
    are held within +-2**26.  Without rows or anchors the result is empty;
    other columns are ignored.
    """
    spark = items.sparkSession
    scratch = Scratch(spark, "negatives")
    vec = F.transform(vec_col, lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), x)).cast("int"))
    base = items.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), vec.alias("vec"),
        F.coalesce(F.col(anchor_col), F.lit(False)).alias("anchor")
    ).where("id is not null and label is not null and vec is not null and not exists(vec, x -> x is null)")
    base = scratch.keep(base, "items")
    if repeating(base, "id"):
        base = numbered(base.groupBy("id", "label", "vec").agg(F.max("anchor").alias("anchor")), "id", "vec", scratch, "row")
    else:
        base = base.withColumn("row", F.col("id"))
    n, width = base.agg(F.count("*"), F.max(F.size("vec"))).first()
    width = max(width or 0, 1)
    base = scratch.keep(base.mapInArrow(lambda it: _packed(it, width), "id long, label string, vec binary, anchor boolean, row long"), "packed")
    sample = base.orderBy(F.xxhash64("row"), "row").limit(MOST_SAMPLE).select("vec").toArrow().column("vec")
    sample = matrix(sample, width) if len(sample) else np.zeros((1, width))
    k = max(1, min(MOST_LISTS, round(n**0.5 / 2), len(sample) // 8, (64 << 20) // (8 * width)))
    centroids = fitted(sample, k)
    rows = scratch.keep(base.mapInArrow(lambda it: _assigned(it, centroids), _ROWS), "lists")
    stats = rows.groupBy("list").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()  # one row for each list
    lists = Lists(centroids, np.full(len(centroids), -1.0), np.zeros(len(centroids), int))
    for r in stats:
        lists.radius[r.list], lists.blocks[r.list] = r.far, -(-r.n // BLOCK)
    blocks = F.element_at(F.lit(lists.blocks.clip(1).tolist()), F.col("list") + 1)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), blocks).cast("int"))

    queries = base.where("anchor").select(F.col("row").alias("query"), F.col("id").alias("anchor_id"), "label", "vec")
    far = 1 << 61
    first = queries.withColumn("lows", F.array(F.lit(-far))).withColumn("highs", F.array(F.lit(far)))
    close = _search(first, rows, lists, positives, True, scratch, "positives")
    ranked = close.select("query", (F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")) - 1).alias("win"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ranked = scratch.keep(ranked, "ranked")
    low, high = _whole(F.col("positive_score") * low_percent, 100, True), _whole(F.col("positive_score") * high_percent, 100, False)
    spans = ranked.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("win", low.alias("low"), high.alias("high")))).alias("w"))  # a few for each query
    second = queries.join(spans, "query").select("query", "label", "vec", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    hard = _search(second, rows, lists, negatives, False, scratch, "negatives")
    order = Window.partitionBy("query", "win").orderBy(F.desc("negative_score"), "negative_id", "row")
    hard = hard.select("query", "win", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "row").withColumn("rank", F.row_number().over(order))
    out = hard.join(ranked, ["query", "win"]).join(queries.select("query", "anchor_id"), "query")
    return scratch.result(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def quantised(embeddings: DataFrame, *, scale: int = 256, every: int = 100, flipped: int = 7, labels: int = 10) -> DataFrame:
    """Rows of (vec_id, embedding, label) for ``mine_hard_negatives``.

    Components become floor(scale * x); rows with a null label or vector or a
    component that is null or not finite are left out; where vec_id is
    divisible by ``flipped`` the label moves on by one; anchors are ids
    divisible by ``every``.
    """
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % flipped == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    rows = embeddings.where(F.col("embedding").isNotNull() & F.col("label").isNotNull()).where(~odd)
    # Bounds before floor(), which turns huge doubles into the largest long.
    vec = F.transform("embedding", lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x.cast("double") * scale))))
    return rows.select(F.col("vec_id").alias("id"), label.alias("label"), vec.alias("vec"), (F.col("vec_id") % every == 0).alias("anchor"))
