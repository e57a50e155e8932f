"""URL decisions: host and path rules, and a character language-model ratio.

Two smoothed variable-order Markov models are trained on characters of accepted
and of rejected URLs.  A URL's score is the difference of its log-likelihoods,
divided by its length; the threshold is calibrated on labelled URLs that the
models haven't seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship

ORDER = 5
#: The rules of the default policy: (verdict, host, path prefix).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def split_url(url: str):
    """Return the host and path expressions of a URL column."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)


def rule_for(host, path, rules=RULES):
    """Return (rule, verdict) expressions: the longest rule whose host holds the URL's and whose path starts it."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):  # later ones win
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _codes(text: pa.Array, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For n = 0 to ``order``: each character with the n before it, packed into an integer; and the rows' lengths.

    Characters are UTF-8 bytes plus an end mark; contexts stop at the start.
    """
    raw = [b"\x02" * order + (t or "").encode() + b"\x03" for t in text.to_pylist()]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    size = np.array([len(r) for r in raw], np.int64)
    at = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
    here = np.flatnonzero(at >= order)
    codes, code = [], np.zeros(len(here), np.uint64)
    for n in range(order + 1):
        code = code | data[here - n] << np.uint64(8 * n)
        codes.append(code | np.uint64(n + 1) << np.uint64(56))
    return codes, size - order


@dataclass(frozen=True)
class CharModel:
    """Counts of characters after contexts of each order, and of the contexts themselves."""

    order: int
    grams: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    kinds: list[np.ndarray]

    def log_likelihoods(self, codes: list[np.ndarray]) -> np.ndarray:
        """Witten-Bell interpolation from the uniform distribution upwards, for each character."""
        p = np.full(len(codes[0]), 1.0 / 256)
        for n in range(self.order + 1):
            c = _lookup(self.grams[n], self.counts[n], codes[n])
            context = codes[n] & ~np.uint64(255)
            total, kinds = _lookup(self.contexts[n], self.totals[n], context), _lookup(self.contexts[n], self.kinds[n], context)
            p = np.where(total > 0, (c + kinds * p) / np.maximum(total + kinds, 1), p)
        return np.log(p)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def train(urls: list[str], order: int = ORDER) -> CharModel:
    """Count all orders over the URLs."""
    codes, _ = _codes(pa.array(urls, pa.string()), order)
    grams, counts, contexts, totals, kinds = [], [], [], [], []
    for code in codes:
        g, c = np.unique(code, return_counts=True)
        ctx, at = np.unique(g & ~np.uint64(255), return_inverse=True)
        grams.append(g)
        counts.append(c)
        contexts.append(ctx)
        totals.append(np.bincount(at, weights=c, minlength=len(ctx)))
        kinds.append(np.bincount(at, minlength=len(ctx)))
    return CharModel(order, grams, counts, contexts, totals, kinds)


@dataclass(frozen=True)
class UrlFilter:
    """Models of accepted and rejected URLs, and the score from which on a URL is accepted."""

    good: CharModel
    bad: CharModel
    threshold: float

    def scores(self, urls: pa.Array) -> np.ndarray:
        """The log-likelihood difference of each URL per character."""
        codes, size = _codes(urls, self.good.order)
        row = np.repeat(np.arange(len(size)), size)
        return np.bincount(row, weights=self.good.log_likelihoods(codes) - self.bad.log_likelihoods(codes), minlength=len(size)) / np.maximum(size, 1)


def fit_filter(accepted: list[str], rejected: list[str], order: int = ORDER) -> UrlFilter:
    """Train on three quarters of each list and set the threshold of least balanced error on the rest."""
    parts = [([u for i, u in enumerate(some) if i % 4], some[::4]) for some in (accepted, rejected)]
    (a, a_held), (r, r_held) = parts
    model = UrlFilter(train(a, order), train(r, order), 0.0)
    if not (a_held and r_held and a and r):
        return model
    good, bad = (np.sort(model.scores(pa.array(x, pa.string()))) for x in (a_held, r_held))
    cuts = np.unique(np.concatenate([good, bad, [0.0]]))
    error = np.searchsorted(good, cuts, "left") / len(good) + 1 - np.searchsorted(bad, cuts, "left") / len(bad)
    best = cuts[error == error.min()]
    return UrlFilter(train(accepted, order), train(rejected, order), float(np.median(best)))


def _scored(batches: Iterator[pa.RecordBatch], model: UrlFilter) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(part.column("url")))], [*part.schema.names, "score"])


def judge_urls(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules=RULES, max_urls: int = 20_000) -> DataFrame:
    """Return page_id, host, path, rule, verdict and score of every row.

    Rules decide where one fits, the longest first; of equally long ones the
    last in order of (verdict, host, path).  URLs they decide, at most
    about ``max_urls`` of each kind by a hash of the URL, train the two models,
    which decide all others: ``allow`` if the score reaches the threshold.
    Equal URLs get equal verdicts.

    A null URL, or one without ``://``, has an empty host and path; a null one
    is scored as an empty text.  Ids may be null or repeat; other columns are
    ignored.  Without training URLs scores are 0 and the verdict is ``allow``.
    """
    ship(pages.sparkSession)
    host, path = split_url("url")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "decided": verdict})
    known = base.where(F.col("decided").isNotNull()).select("url", "decided").distinct()
    sizes = {r.decided: r.n for r in known.groupBy("decided").agg(F.count("*").alias("n")).collect()}
    share = F.lit(1.0)
    for kind, n in sizes.items():
        share = F.when(F.col("decided") == kind, F.lit(min(1.0, max_urls / n))).otherwise(share)
    rows = known.where(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < share * (1 << 20)).orderBy(F.xxhash64("url"), "url").collect() if sizes else []
    model = fit_filter([r.url for r in rows if r.decided == "allow"], [r.url for r in rows if r.decided == "block"])
    scored = base.mapInArrow(lambda it: _scored(it, model), "page_id long, url string, host string, path string, rule string, decided string, score double")
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("decided", F.when(F.col("score") >= model.threshold, "allow").otherwise("block")).alias("verdict"), "score"
    )
