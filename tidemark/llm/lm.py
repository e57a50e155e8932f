"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of a word given the word before
it, of the word alone, and a uniform one:

    p(w | v) = a_b c(v w) / c(v) + u_b c(w) / N + z_b / (V + 1)

The weights, which sum to one, depend on the frequency bucket ``b`` of the
context ``v``.  Expectation-maximisation learns them
on the counts of held-out training documents, whose own counts are deleted
from the rest; there, and only there, estimates are rounded to an eighth of an
octave, so that their table stays small.  Counts come from all training documents: chunks send their
distinct n-grams to hash ranges, which sum them and answer each chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import pack_chunks, packed_counts, packed_keys, release, rows_of, runs, unpacked, unpacked_counts, unpacked_keys
from tidemark.llm.scratch import Scratch
from tidemark.llm.words import MIX_A, lowered, mix64, new_seed, span_hashes, word_spans

#: The end mark's hash, and the context before a text's first token.
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0xD1342543DE82EF95)
BUCKETS = 24


def tokens_of(offsets: np.ndarray, data: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Return the token hashes of a chunk, each document ended by the end mark, and the token offsets."""
    data = lowered(data)
    starts, ends, bounds = word_spans(data, offsets)
    words = span_hashes(data, starts, ends, seed)
    n = len(offsets) - 1
    out = np.full(len(words) + n, END, np.uint64)
    doc = np.repeat(np.arange(n), np.diff(bounds))
    out[np.arange(len(words)) + doc] = words
    return out, bounds + np.arange(n + 1)


def pairs_of(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return the context of each token and the hash of (context, token)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    if len(tokens):
        before[bounds[:-1]] = START
    return before, mix64(before * _PAIR ^ mix64(tokens ^ MIX_A))


def _bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.log2(np.maximum(count, 0) + 1.0).astype(np.int64))


#: Groups of documents; a chunk holds documents of one.
TRAIN, HELD, TEST = 0, 1, 2


def _keys(row: dict, seed: int):
    """The chunk's tokens with their contexts, and its distinct words and pairs with each token's place among them."""
    ids, offsets, data = unpacked(row)
    tokens, bounds = tokens_of(offsets, data, seed)
    before, pair = pairs_of(tokens, bounds)
    # The start stands once for each document, as the context of its first token.
    words, at = np.unique(np.concatenate([tokens, np.full(len(ids), START, np.uint64)]), return_inverse=True)
    grams, gat = np.unique(pair, return_inverse=True)
    return ids, bounds, tokens, before, words, at, grams, gat


_ASK = "part int, chunk long, grp int, words binary, wn binary, grams binary, gn binary"
_ASK_ARROW = [("part", pa.int32()), ("chunk", pa.int64()), ("grp", pa.int32()), *((k, pa.binary()) for k in ("words", "wn", "grams", "gn"))]
_TOLD = "part int, chunk long, grp int, wn binary, gn binary, wh binary, gh binary, tokens long, types long, held long"
_TOLD_ARROW = [
    ("part", pa.int32()), ("chunk", pa.int64()), ("grp", pa.int32()), *((k, pa.binary()) for k in ("wn", "gn", "wh", "gh")),
    *((k, pa.int64()) for k in ("tokens", "types", "held"))
]


def _batch(schema, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(schema)], [n for n, _ in schema])


def _ask(batches: Iterator[pa.RecordBatch], parts: int, seed: int) -> Iterator[pa.RecordBatch]:
    """For each chunk and hash range: its distinct words and pairs, and how often they occur (test documents: never)."""
    for row in rows_of(batches):
        *_, words, at, grams, gat = _keys(row, seed)
        learn = int(row["grp"] != TEST)
        wn, gn = (np.bincount(x, minlength=len(k)) * learn for x, k in ((at, words), (gat, grams)))
        mine, his = ({p: slice(a, b) for p, a, b in zip(*(x.tolist() for x in runs(k, parts)), strict=True)} for k in (words, grams))
        rows = []
        for p in sorted(mine.keys() | his.keys()):
            w, g = mine.get(p, slice(0, 0)), his.get(p, slice(0, 0))
            rows.append((p, row["chunk"], row["grp"], packed_keys(words[w]), packed_counts(wn[w]), packed_keys(grams[g]), packed_counts(gn[g])))
        if rows:
            yield _batch(_ASK_ARROW, rows)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray], held: list[bool]) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """The counts of all inputs and of the held-out ones, as seen from each input; and how many keys have any."""
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    edges = np.cumsum([len(k) for k in keys])[:-1]
    n = np.concatenate(counts)
    out = np.concatenate([c * h for c, h in zip(counts, held, strict=True)])
    total, part = np.bincount(at, weights=n), np.bincount(at, weights=out)
    return np.split(total[at], edges), np.split(part[at], edges), int((total > 0).sum())


def _tell(table: pa.Table) -> pa.Table:
    """Sum a hash range, and answer every chunk in its own order; chunk -1 gets the totals."""
    release()
    part, chunks, groups = table.column("part")[0].as_py(), table.column("chunk").to_pylist(), table.column("grp").to_pylist()
    get = lambda c, f: [f(x.as_py()) for x in table.column(c)]
    held = [g == HELD for g in groups]
    words, wn = get("words", unpacked_keys), get("wn", unpacked_counts)
    w, wh, known = _summed(words, wn, held)
    g, gh, _ = _summed(get("grams", unpacked_keys), get("gn", unpacked_counts), held)
    sums = [int(c[k != START].sum()) for k, c in zip(words, wn, strict=True)]
    start = any(((k == START) & (c > 0)).any() for k, c in zip(words, wn, strict=True))
    rows = []
    for i, (chunk, group) in enumerate(zip(chunks, groups, strict=True)):
        rows.append(
            (
                part, chunk, group, packed_counts(w[i]), packed_counts(g[i]),
                *((packed_counts(wh[i]), packed_counts(gh[i])) if held[i] else (None, None)), None, None, None
            )
        )
    rows.append((part, -1, -1, None, None, None, None, sum(sums), known - start, sum(s for s, h in zip(sums, held, strict=True) if h)))
    return pa.Table.from_batches([_batch(_TOLD_ARROW, rows)])


def _answers(row: dict, which: tuple[str, str], seed: int):
    """The chunk's documents, and of each token the counts of itself, its context and both together."""
    ids, bounds, tokens, before, words, at, _, gat = _keys(row, seed)
    told = sorted(row["told"], key=lambda x: x["part"])
    wn, gn = (np.concatenate([unpacked_counts(x[k]) for x in told]).astype(np.int64) for k in which)
    return ids, bounds, (wn[at[: len(tokens)]], wn[np.searchsorted(words, before)], gn[gat])


_GRID = 8.0
_SIDE = 400


def _grid(p: np.ndarray) -> np.ndarray:
    """A bin of a log scale, an eighth of an octave wide; 0 stands for zero."""
    return np.where(p > 0, np.clip(np.rint(-_GRID * np.log2(np.maximum(p, 1e-15))) + 1, 1, _SIDE - 1), 0).astype(np.int64)


def _held_out(batches: Iterator[pa.RecordBatch], n: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Held-out counts by (context bucket, pair estimate, word estimate), the estimates on a log grid."""
    codes, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row in rows_of(batches):
        w, v, g = (a - h for a, h in zip(_answers(row, ("wn", "gn"), seed)[2], _answers(row, ("wh", "gh"), seed)[2], strict=True))
        code = (_bucket(v) * _SIDE + _grid(g / np.maximum(v, 1))) * _SIDE + _grid(w / n)
        u, c = np.unique(code, return_counts=True)
        codes.append(u)
        weights.append(c)
        if len(codes) > 64:
            u, at = np.unique(np.concatenate(codes), return_inverse=True)
            codes, weights = [u], [np.bincount(at, weights=np.concatenate(weights)).astype(np.int64)]
    u, at = np.unique(np.concatenate(codes), return_inverse=True)
    if len(u):
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(np.bincount(at, weights=np.concatenate(weights)).astype(np.int64))], ["code", "n"])


def learn_weights(code: np.ndarray, count: np.ndarray, types: int, rounds: int = 60) -> np.ndarray:
    """Learn the (BUCKETS, 3) mixture weights by expectation-maximisation on held-out counts."""
    weights = np.tile([0.5, 0.4, 0.1], (BUCKETS, 1))
    if len(code):
        value = lambda g: np.where(g > 0, 2.0 ** (-(g - 1) / _GRID), 0.0)
        estimates = np.stack([value(code // _SIDE % _SIDE), value(code % _SIDE), np.full(len(code), 1.0 / (types + 1))])
        b = code // _SIDE**2
        for _ in range(rounds):
            shares = weights[b].T * estimates
            shares *= count / shares.sum(axis=0)
            # Half a count for each part keeps all weights above zero.
            total = np.stack([np.bincount(b, weights=s, minlength=BUCKETS) for s in shares], axis=1) + 0.5
            weights = total / total.sum(axis=1, keepdims=True)
    weights[0, 0] = 0.0  # a context that never occurred predicts nothing
    weights[0] /= weights[0].sum()
    return weights


def _scored(batches: Iterator[pa.RecordBatch], n: int, types: int, weights: np.ndarray, seed: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        ids, bounds, (w, v, g) = _answers(row, ("wn", "gn"), seed)
        doc = np.repeat(np.arange(len(ids)), np.diff(bounds))
        w, v, g = (x.astype(np.float64) for x in (w, v, g))
        b = _bucket(v)
        p = weights[b, 0] * g / np.maximum(v, 1) + weights[b, 1] * w / max(n, 1) + weights[b, 2] / (types + 1)
        size = len(ids)
        sums = [np.bincount(doc, weights=x, minlength=size) for x in (np.log10((w + 1) / (n + types + 1)), np.log10(p), w > 0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(np.full(size, row["grp"] == TEST)), pa.array(np.diff(bounds)), pa.array(sums[2].astype(np.int64)), pa.array(np.full(size, n, np.int64)), pa.array(sums[0]), pa.array(sums[1])],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )


def lm_scores(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, test: int = 2, held: int = 3,
    part_bytes: int = 8 << 20
) -> DataFrame:
    """Return doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document.

    Documents in fold ``test`` (crc32 of the id as text, modulo ``folds``) are
    never learnt from.  Fold ``held`` trains the mixture weights against the
    counts of the other training folds; the final counts include it.
    Words are counted by 64-bit hashes under a seed drawn for the run.
    ``base_score`` is the add-one unigram score over N + 1 * (V + 1), and
    ``score`` the mixture's log10 probability.

    A null or empty text is one end mark.  Rows with a null id count as held
    out, learn nothing, and come back with null scores.  Rows that repeat an id
    are separate documents.  Without training documents both scores are those
    of the uniform model.  Other columns are ignored.
    """
    scratch, seed = Scratch(docs.sparkSession, "lm"), new_seed()
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % folds
    group = F.when(fold == test, TEST).when(fold == held, HELD).otherwise(TRAIN)
    chunks = scratch.keep(pack_chunks(base.where("id is not null").withColumn("grp", group)), "chunks")
    size = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    parts = max(8, -(-size // part_bytes))
    asked = chunks.mapInArrow(lambda it: _ask(it, parts, seed), _ASK)
    # Twice as many tasks as ranges, so that few of them get several.
    told = scratch.keep(asked.repartition(2 * parts, "part").groupBy("part").applyInArrow(_tell, _TOLD), "told")
    n, types, n_held = told.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "held"))).first()

    def answered(some: str, columns: list[str]) -> DataFrame:
        by_chunk = told.where(some).groupBy("chunk").agg(F.collect_list(F.struct("part", *columns)).alias("told"))
        return chunks.where(some).join(by_chunk, "chunk")

    marked = answered(f"grp = {HELD}", ["wn", "gn", "wh", "gh"]).mapInArrow(lambda it: _held_out(it, max(1, n - n_held), seed), "code long, n long")
    grid = marked.groupBy("code").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS * _SIDE**2 cells
    weights = learn_weights(grid["code"].to_numpy(np.int64), grid["n"].to_numpy(np.float64), types)
    out = answered("grp >= 0", ["wn", "gn"]).mapInArrow(
        lambda it: _scored(it, n, types, weights, seed),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    lost = base.where("id is null").selectExpr(
        "id as doc_id", "true as held_out", "cast(null as long) as n_tokens", "cast(null as long) as n_known",
        f"cast({n} as long) as train_tokens", "cast(null as double) as base_score", "cast(null as double) as score"
    )
    return scratch.result(out.unionByName(lost))
