"""Connected components by alternating star contractions, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch


def connected_components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """Return (id, component), the smallest reachable id, for every id in ``links``.

    Every round keeps a graph with the same components: first each node ties
    its larger neighbours to its smallest one, then each node ties its smaller
    neighbours to that one.  It ends when the links are stars around the
    smallest ids.  Nulls and self links are ignored; an empty table gives an
    empty result.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = scratch.keep(edges, "edges")
    mark = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before, k = edges.agg(*mark).first(), 0
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(low, "u")
        small = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        k += 1
        new = scratch.keep(small, f"edges{k}")
        scratch.drop(f"edges{k - 1}" if k > 1 else "edges")
        edges = new
        now = edges.agg(*mark).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
