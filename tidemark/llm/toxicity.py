"""Toxic passages as maximum-scoring segments of token log-odds.

A token's score is its log-odds between toxic and other documents under an
informative Dirichlet prior, at the end of its confidence interval that is
nearer to zero, less a drift that makes ordinary text lose.  One
linear scan finds all maximal segments of a document.  Segment scores of
ordinary text follow an extreme-value law; with its two parameters each segment
gets an expected number of such segments by chance, and a document's best and
total significance become a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch, small_batches
from tidemark.llm.words import NOT_ALNUM, lowered, span_hashes, text_bytes, text_slices, word_spans

EULER = 0.5772156649015329
#: A segment counts as a passage if chance makes fewer than so many of it.
EXPECTED = 0.05
PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """Return all maximal scoring segments as (start, end, score), in linear time.

    Ruzzo and Tompa's scan: each candidate keeps the sums left and right of it;
    a new one joins those before it as far as that raises its score.
    """
    total, stack = 0.0, []  # of (start, end, sum left of it, sum up to its end, place of the last one with a smaller left sum)
    for i, s in enumerate(scores):
        left, total = total, total + s
        if s <= 0:
            continue
        start = i
        at = len(stack) - 1
        while True:
            while at >= 0 and stack[at][2] >= left:
                at = stack[at][4]
            if at < 0 or stack[at][3] >= total:
                stack.append((start, i + 1, left, total, at))
                break
            start, _, left, _, before = stack[at]
            del stack[at:]
            at = before
    return [(a, b, right - left) for a, b, left, right, _ in stack]


@dataclass(frozen=True)
class ToxicityModel:
    """Scores of known tokens by hash, the drift, the extreme-value parameters and the calibration."""

    hashes: np.ndarray
    scores: np.ndarray
    drift: float
    rate: float
    log_k: float
    weights: tuple[float, float, float]

    def probability(self, best: np.ndarray, total: np.ndarray) -> np.ndarray:
        b, w1, w2 = self.weights
        return 1.0 / (1.0 + np.exp(-np.clip(b + w1 * best + w2 * total, -500, 500)))


def _tokens(text: pa.Array):
    data, offsets = text_bytes(text)
    data = lowered(data)
    starts, ends, bounds = word_spans(data, offsets, NOT_ALNUM)
    return span_hashes(data, starts, ends), starts, ends, bounds, offsets


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task: in how many toxic and other documents each token occurs, and how often."""
    keys, sums = [], []

    def merged():
        u, at = np.unique(np.concatenate(keys), return_inverse=True)
        return u, np.stack([np.bincount(at, weights=np.concatenate([s[:, k] for s in sums])) for k in range(4)], axis=1)

    for batch in batches:
        for part in text_slices(batch, "text"):
            h, _, _, bounds, _ = _tokens(part.column("text"))
            toxic = part.column("toxic").to_numpy()
            doc = np.repeat(np.arange(len(toxic)), np.diff(bounds))
            order = np.lexsort((h, doc))
            h, doc = h[order], doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            y = toxic[doc] == 1
            u, at = np.unique(h, return_inverse=True)
            keys.append(u)
            sums.append(np.stack([np.bincount(at, weights=w, minlength=len(u)) for w in (new & y, new & ~y, y, ~y)], axis=1))
            if sum(map(len, keys)) > 1 << 20:
                u, s = merged()
                keys, sums = [u], [s]
    if keys:
        u, s = merged()
        for at in range(0, len(u), 1 << 14):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(u[at : at + (1 << 14)].view(np.int64)),
                    *(pa.array(s[at : at + (1 << 14), k].astype(np.int64)) for k in range(4))
                ],
                ["h", "d1", "d0", "t1", "t0"]
            )


def _segments(part: pa.RecordBatch, model: ToxicityModel):
    """For each row: number of tokens, and maximal segments above the level of interest."""
    h, starts, ends, bounds, offsets = _tokens(part.column("text"))
    s = np.full(len(h), -model.drift)
    if len(model.hashes) and len(h):
        at = np.minimum(np.searchsorted(model.hashes, h), len(model.hashes) - 1)
        hit = model.hashes[at] == h
        s[hit] = model.scores[at[hit]] - model.drift
    n = np.diff(bounds)
    positive = np.add.reduceat(np.append((s > 0).astype(np.int64), 0), np.minimum(bounds[:-1], len(s))) * (n > 0)
    found: list[list[tuple[int, int, float]]] = []
    for i, k in enumerate(positive.tolist()):
        if not k:
            found.append([])
            continue
        a, b = int(bounds[i]), int(bounds[i + 1])
        own = s[a:b]
        # Runs of one sign are single steps of the scan.
        up = own > 0
        edge = np.flatnonzero(np.append(True, up[1:] != up[:-1]))
        last = np.append(edge[1:], len(own))
        runs = np.add.reduceat(own, edge).tolist()
        found.append([(int(starts[a + edge[x]] - offsets[i]), int(ends[a + last[y - 1] - 1] - offsets[i]), v) for x, y, v in maximal_segments(runs)])
    return n, found


def _figures(n: np.ndarray, found: list, model: ToxicityModel) -> tuple[np.ndarray, np.ndarray]:
    """The best and the total normalised score of each row's segments; texts without one get the floor."""
    best, total = np.full(len(n), -5.0), np.zeros(len(n))
    for i, segments in enumerate(found):
        if segments:
            norm = model.rate * np.array([v for _, _, v in segments]) - model.log_k - np.log(max(1, n[i]))
            best[i] = max(norm.max(), -5.0)
            total[i] = norm[norm > -np.log(EXPECTED)].sum()
    return best, total


def _calibrated(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            n, found = _segments(part, model)
            top = [max((v for _, _, v in f), default=0.0) for f in found]
            total = [[v for _, _, v in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(n), pa.array(top, pa.float64()), pa.array(total, pa.list_(pa.float64())), part.column("toxic")],
                ["n", "top", "segments", "toxic"]
            )


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the first column is the constant."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w)), x.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _rate(scores: np.ndarray, mass: np.ndarray) -> float:
    """The positive root of sum(mass * exp(rate * score)) = 1; scores have a negative mean."""
    value = lambda r: float((mass * np.exp(np.clip(r * scores, -700, 700))).sum()) - 1.0
    low, high = 1e-6, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return (low + high) / 2


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    folds: int = 4, test: int = 2, calibrate: int = 3, max_rows: int = 60_000, prior: float = 0.1, drift: float = 0.3,
    least_z: float = 1.96, least_docs: int = 3
) -> ToxicityModel:
    """Learn a model from labelled documents outside fold ``test`` (crc32 of the id as text, modulo ``folds``).

    Fold ``calibrate`` sets the extreme-value parameters and the probabilities,
    the others the token scores.  At most about ``max_rows`` labelled documents
    are used, by a hash of their ids; all their significant tokens are kept.
    Equal texts count once.  Null ids, labels and texts
    teach nothing; without labels of both kinds every score is the share of
    toxic labels.
    """
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % folds
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic")
    ).groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("fold", fold).where(F.col("fold") != test)
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Both tables broadcast here have about ``max_rows`` small rows at most.
    rows = texts.join(F.broadcast(known), "id").withColumn("same", F.xxhash64("text"))
    scratch = Scratch(docs.sparkSession, "toxicity")
    first = scratch.keep(rows.groupBy("same").agg(F.min("id").alias("id")), "first")
    rows = rows.join(F.broadcast(first), ["same", "id"], "left_semi").select("text", "toxic", "fold")
    counts = rows.where(F.col("fold") != calibrate).select("text", "toxic").mapInArrow(
        _counted, "h long, d1 long, d0 long, t1 long, t0 long"
    ).groupBy("h").agg(*(F.sum(c).alias(c) for c in ("d1", "d0", "t1", "t0")))
    counts = scratch.keep(counts, "counts")
    n1, n0, k0, k = counts.agg(F.coalesce(F.sum("d1"), F.lit(0)), F.coalesce(F.sum("d0"), F.lit(0)), F.coalesce(F.sum("t0"), F.lit(0)), F.count("*")).first()
    none = np.zeros(0, np.uint64), np.zeros(0)
    hashes, scores, rate = *none, 1.0
    if n1 and n0:
        # Log-odds with a prior in proportion to each token's share of all; ``prior`` is its weight against the data.
        a, all_a = F.lit(prior) * (F.col("d1") + F.col("d0")), prior * (n1 + n0)
        raw = F.log((F.col("d1") + a) / (F.lit(n1 + all_a) - F.col("d1") - a)) - F.log((F.col("d0") + a) / (F.lit(n0 + all_a) - F.col("d0") - a))
        error = F.sqrt(1 / (F.col("d1") + a) + 1 / (F.col("d0") + a))
        z = raw / error
        odds = raw - F.signum(raw) * least_z * error
        # of the tokens of ``max_rows`` texts at most
        top = counts.where(F.col("d1") + F.col("d0") >= least_docs).select(
            "h", "t0", odds.alias("odds"), z.alias("z")
        ).where(F.abs("z") >= least_z).toPandas()
        h = top["h"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(h)
        hashes, scores = h[order], top["odds"].to_numpy()[order]
        share = np.append(top["t0"].to_numpy()[order], max(0, k0 - top["t0"].sum())) / max(1, k0)
        rate = _rate(np.append(scores, 0.0) - drift, share)
    model = ToxicityModel(hashes, scores, drift, rate, 0.0, (0.0, 0.0, 0.0))
    with small_batches(docs.sparkSession):
        # about max_rows / folds rows
        held = rows.where(F.col("fold") == calibrate).select("text", "toxic").mapInArrow(
            lambda it: _calibrated(it, model), "n long, top double, segments array<double>, toxic int"
        ).toPandas()
    scratch.drop("counts")
    scratch.drop("first")
    y = held["toxic"].to_numpy(np.float64)
    clean = held[(held["toxic"] == 0) & (held["n"] > 0) & (held["top"] > 0)]
    log_k = float((rate * clean["top"] - np.log(clean["n"])).median() + np.log(np.log(2.0))) if len(clean) else 0.0
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return ToxicityModel(hashes, scores, drift, rate, log_k, (float(np.log(p / (1 - p))), 0.0, 0.0))
    shaped = ToxicityModel(hashes, scores, drift, rate, log_k, (0.0, 0.0, 0.0))
    best, total = _figures(held["n"].to_numpy(), [[(0, 0, v) for v in s] for s in held["segments"]], shaped)
    w = _logistic(np.stack([np.ones(len(y)), best, total], axis=1), y)
    return ToxicityModel(hashes, scores, drift, rate, log_k, tuple(float(v) for v in w))


def _scored(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            n, found = _segments(part, model)
            best, total = _figures(n, found, model)
            passages = []
            for i, segments in enumerate(found):
                level = model.log_k + np.log(max(1, n[i]))
                rows = [(a, b, v, float(np.exp(np.clip(level - model.rate * v, -700, 700)))) for a, b, v in segments]
                passages.append([{"start": a, "end": b, "score": float(v), "expected": e} for a, b, v, e in rows if e < EXPECTED])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(model.probability(best, total)), pa.array(passages, kind)],
                ["doc_id", "score", "passages"]
            )


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id, score and passages (byte ranges, score, expected number by chance) of each document.

    A null or empty text has no passages and the score of such a text; null
    and repeated ids come back as they are.  Other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return Scratch(docs.sparkSession, "toxicity").result(base.mapInArrow(lambda it: _scored(it, model), f"doc_id long, score double, passages {PASSAGES}"))
