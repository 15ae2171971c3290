"""The dealt operators as registered queries: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.llm import (
    alignment,
    bpe,
    decontaminate,
    divergence,
    language,
    packing,
    phrases,
    quality,
    simhash,
    substring_dedup,
    token_files,
    toxicity,
    warc,
)
from roadcast.llm.common import fold

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.neighbour_fingerprints(table(spark, sf_dir, "documents"))


@register
def op5_simhash_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.linked_documents(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return linked.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


@register
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_files.token_table(table(spark, sf_dir, "documents"), tokenizer, end_id=2)


@register
def op9_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer, end_id=0, capacity=2048)
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register
def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op10_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register
def op7_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.deduplicated(docs, length=50).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register
def op3_language_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fitted(docs.filter(fold("doc_id", 4) != 2))
    found = language.languages(docs.select("doc_id", "text"), model)
    held_out = (fold("doc_id", 4) == 2).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", F.col("lang_score").alias("score"))


@register
def op6_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fitted(docs, labels.filter(fold("doc_id", 5) != 0))
    return toxicity.scored(docs, model).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@register
def op2_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades from the two labels: 0 is bad writing, 1 is good but toxic, 2 is good and clean."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    ratings = table(spark, sf_dir, "labels").select("doc_id", grade.alias("label"))
    model = quality.fitted(docs, ratings.filter(fold("doc_id", 5) != 0))
    tail = F.get("tails", F.lit(0))
    return quality.graded(docs, model).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "expected_grade",
        F.coalesce(tail, F.lit(0.0)).alias("p_good"),
        F.coalesce(F.get("tails", F.lit(1)), F.lit(0.0)).alias("p_clean"),
        F.coalesce(tail >= 0.5, F.lit(False)).alias("keep"),
    )


@register
def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.coded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register
def op11_aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.aligned(table(spark, sf_dir, "documents"), *paths)


@register
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=30, top=50)
