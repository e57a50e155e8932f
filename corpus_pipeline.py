"""A training corpus from raw documents, stage by stage.

Every stage takes null and repeated ids, null, empty and very long texts, ties,
repeated rows, empty tables and extra columns of any name.  Each row is judged
as a document of its own, whatever other rows share its id.  All stages but the
last return the columns they got.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import benchmark_leaks
from tidemark.llm.near_dup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.repeats import repeated_bytes
from tidemark.llm.rows import numbered, repeating, without
from tidemark.llm.scratch import Scratch, drop_results, owned, results_so_far
from tidemark.llm.toxicity import learn_toxicity, score_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOXIC = 0.3


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _keyed(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """``docs`` with a unique key, and its name: doc_id itself, or where ids repeat or are null the place in order of doc_id, null ids last."""
    name = _free(docs, "_row")
    if repeating(docs, "doc_id"):
        placed = numbered(docs, "doc_id", "text", scratch, name)
        owned(scratch.spark, scratch.made["placed"])
        return placed, name
    return docs.withColumn(name, F.col("doc_id").cast("long")), name


def _without(docs: DataFrame, key: str, rows: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of the keyed ``docs`` without the ``rows``, whose keys are in doc_id."""
    return without(docs, key, rows.select(F.col("doc_id").alias(key))).select(columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity reaches 0.3.

    Labels reach texts by doc_id.  Null and empty texts have the score of a
    text without passages; equal texts get equal scores.  Without labels of
    both kinds every score is the share of toxic labels.
    """
    model = learn_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keyed, key = _keyed(docs, Scratch(spark, "rows"))
    return _without(keyed, key, score_toxicity(keyed, model, id_col=key).where(F.col("score") >= TOXIC), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: five-word shingles, similarity 0.8.

    Of a group the smallest id stays, and a null id only if all ids are null;
    of equal rows one stays, rows that share an id and nothing else all stay.
    Texts without words have no duplicates and stay.
    """
    keyed, key = _keyed(docs, Scratch(spark, "rows"))
    return _without(keyed, key, near_duplicates(keyed, id_col=key, width=5, percent=80).where(~F.col("kept")), docs.columns)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated 100-byte strings out of the texts, whole characters only; drop texts of which nothing is left.

    Of equal rows the first stays whole and the others go.  Rows with a null
    id take part, after all others.  Null and empty texts stay as they are.  A
    column n_chars, if there is one, gets the new length of a cut text.
    """
    keyed, key = _keyed(docs, Scratch(spark, "rows"))
    kept = _free(keyed, "_kept")
    found = repeated_bytes(keyed, id_col=key, length=100, whole_chars=True, with_text=True).where("n_removed > 0")
    found = found.select(F.col("doc_id").alias(key), F.decode("kept", "UTF-8").alias(kept))
    cut = keyed.join(found, key, "left").where(F.col(kept).isNull() | (F.col(kept) != ""))
    if "n_chars" in docs.columns:
        size = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(kept))
        cut = cut.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return cut.withColumn("text", F.coalesce(kept, "text")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark items; null and empty texts hold none."""
    keyed, key = _keyed(docs, Scratch(spark, "rows"))
    leaks = benchmark_leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key)
    return _without(keyed, key, leaks, docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens; a null or empty text is the end id alone."""
    return pack(docs, tokenizer="byte_bpe_50k.json", end_id=0, capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_removal),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written and read again, and goes, with all that it made, when the next is there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "corpus")
    for name, stage in STAGES[:-1]:
        before = results_so_far(spark)
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        drop_results(spark, before)
        for older in [n for n in scratch.made if n != name]:
            scratch.drop(older)
    out = STAGES[-1][1](spark, docs, sf_dir)
    scratch.drop(STAGES[-2][0])
    return out


ORACLE_SQL = None
