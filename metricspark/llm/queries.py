"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.llm.decontaminate import find_contamination
from metricspark.llm.divergence import audit_sources
from metricspark.llm.extraction import extract_main_text
from metricspark.llm.extraction import train as train_chain
from metricspark.llm.kdtree import top_k
from metricspark.llm.lm import score_corpus
from metricspark.llm.neardup import near_duplicates
from metricspark.llm.packing import pack_documents
from metricspark.llm.phrases import mine_phrases
from metricspark.llm.pii import pseudonymize
from metricspark.llm.preferences import last_reply_branches, preference_segments
from metricspark.llm.sharding import assign_shards
from metricspark.llm.text import table
from metricspark.llm.toxicity import Model, score_texts, train
from metricspark.llm.urlfilter import host_rule, judge_urls

SHARDS = 40
#: The tokenizer's file among the public ones; its folder must exist on all executors.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


#: Scores from which a text counts as toxic.
TOXIC = 0.7
#: Key of the pseudonyms in the registered queries; use a secret one of your own.
PII_KEY = "example-key"

#: Host, path and verdict of the rules on page URLs.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def remainder(number: int):
    """crc32 of doc_id as text modulo ``number``; a null id counts as the text "null"."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % number


def toxicity_model(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labels outside the held-out third."""
    return train(docs, labels.where(remainder(3) != 1))


def op1_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_segments(last_reply_branches(table(spark, sf_dir, "conversations")))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_main_text(pages, train_chain(pages)).select("page_id", "url", "text", "n_chars")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted")
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_kd_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(table(spark, sf_dir, "documents"), remainder(10) == 0)


def op7_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms, and the spans they stand for."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, PII_KEY).withColumn("n_pii", F.coalesce(F.size("pii_spans"), F.lit(0)))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_key")


def op10_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), [host_rule(*rule) for rule in URL_RULES])


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_preference_formatting": op1_preference_formatting,
    "op2_main_text": op2_main_text,
    "op3_toxicity": op3_toxicity,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_kd_tree_search": op5_kd_tree_search,
    "op6_deleted_interpolation": op6_deleted_interpolation,
    "op7_pattern_packing": op7_pattern_packing,
    "op8_pseudonyms": op8_pseudonyms,
    "op9_decontamination": op9_decontamination,
    "op10_rendezvous_shards": op10_rendezvous_shards,
    "op11_url_filter": op11_url_filter,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_source_divergence": op13_source_divergence,
}
