"""The corpus pipeline: toxic texts, near copies and benchmark leaks go, personal data is
exchanged, and what is left is packed into sequences."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.llm.decontaminate import find_contamination
from metricspark.llm.neardup import near_duplicates, raw_digest
from metricspark.llm.packing import pack_documents
from metricspark.llm.pii import pseudonymize
from metricspark.llm.queries import PII_KEY, TOXIC, tokenizer_path, toxicity_model
from metricspark.llm.text import free_name, small_batches, table
from metricspark.llm.toxicity import score_texts
from metricspark.session import durable

#: Words of a shingle in the near-duplicate stage.
SHINGLE = 5
#: Parts of texts whose ids a Python worker keeps: it stays with its executor for the stages of the next run.
KEPT_PARTS = 200_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stored(stage: Stage) -> Stage:
    """A stage that writes its rows in small batches, as the size of batches is a setting of the
    session when rows are made, which may be long after the stage has returned."""

    @wraps(stage)
    def made(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return durable(stage(spark, docs, sf_dir), stage.__name__)

    return made


@stored
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the bound; the classifier learns from labelled rows of ``docs``."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "_score")
    return score_texts(docs, model, score).where(F.col(score) < TOXIC).select(*(f"`{c}`" for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near copies: the one of the smallest doc_id. Of several rows
    with one doc_id and one text the smallest row stays, and different texts under one
    doc_id are texts of their own; rows without a doc_id all stay."""
    with small_batches(spark):
        found = near_duplicates(docs, SHINGLE, by_text=True).where("doc_id IS NOT NULL")
        texts = found.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
        # What is not one row that stays, by the text as it is, so that no Python is needed to find it again.
        others = found.select("doc_id", "digest", "raw").distinct().join(texts.where("NOT kept OR n > 1"), ["doc_id", "digest"])
        others = durable(others.select("doc_id", "raw", "digest", "kept"), "other-texts")
        # Of its own size, mostly small, so that whole texts are shuffled once.
        repeated = durable(others.where("kept").drop("kept"), "repeated-texts")
    raw, digest = free_name(docs, "_raw"), free_name(docs, "_digest")
    keyed, same = docs.withColumn(raw, raw_digest(F.col("text"))), ["doc_id", raw]
    rest = keyed.join(others.select("doc_id", F.col("raw").alias(raw)), same, "left_anti")
    several = keyed.join(repeated.select("doc_id", F.col("raw").alias(raw), F.col("digest").alias(digest)), same)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    smallest = several.groupBy("doc_id", digest).agg(F.min(row).alias("row")).select("row.*")
    return rest.select(*(f"`{c}`" for c in docs.columns)).unionByName(smallest)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word in a benchmark window."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    leaks = found.where("contaminated").select("doc_id", "_key")
    same = docs["doc_id"].eqNullSafe(leaks["doc_id"]) & (F.xxhash64(docs["text"]) == leaks["_key"])
    return docs.join(leaks, same, "left_anti")


@stored
def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal values; n_chars follows the text."""
    safe = pseudonymize(docs, PII_KEY)
    return safe.withColumn("n_chars", F.length("text").cast("bigint")).select(*(f"`{c}`" for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document, in sequences of at most 1024 tokens."""
    with small_batches(spark):
        return pack_documents(docs, tokenizer_path(), keep_parts=KEPT_PARTS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: Models and keyed pseudonyms are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each reads what the one before has written. Python workers
    and buffers stay with an executor from stage to stage, so all stages take small batches."""
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES[:-1]:
            docs = durable(inspect.unwrap(stage)(spark, docs, sf_dir), name)  # written once
    return STAGES[-1][1](spark, docs, sf_dir)
