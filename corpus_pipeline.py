"""A corpus made ready for training, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again before the next. All but the last return the columns of their input.

* ``language``: texts without a letter go, and those whose words fit no language: the mean of every
  word's greatest marginal is below ``LEAST_CONFIDENCE``. A text in several languages stays, and where
  no language can be learned, all texts do.
* ``near_duplicates``: of every group of documents linked by SimHash (fingerprints of three-word shingles
  that differ in at most two bits) the one with the least id stays; of rows that share that id in a
  group, the one with the least hash of all columns, once.
* ``repeated_substrings``: every 50-byte string that a document with a smaller id has too is cut
  out; a character of which a part went goes as well.
* ``benchmark_overlap``: the spans of benchmark phrases are cut out.
* ``packing``: the rest is cut and packed into sequences of 2,048 tokens.

Documents that lose text stay if a letter or digit is left. ``n_chars``, where there is such
a column, follows the text. A group whose documents all have null ids keeps one of them, and
any id comes before a null one; nothing is cut from documents with a null id for repeating others. Other columns pass
through whatever their names. Empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadcast.llm import decontaminate, language, packing, simhash, substring_dedup
from roadcast.llm.common import fold, stored

LEAST_CONFIDENCE = 0.5
SHINGLE, MOST_BITS = 3, 2
BATCH_ROWS = 1000  # of texts between the JVM and Python workers: stages share executors, and long texts add up
FOLDS, HELD_OUT = 4, 2  # crc32 of the id: the language model never sees this part's labels
TOKENS, END_ID = 2048, 0
ORACLE_SQL = None  # SQL has neither the models nor the tokenizer; tests/llm/test_pipeline.py tests each stage


def wrapped(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """The named columns, and all but the text in ``rest``, where no operator's columns can clash with them."""
    rest = [c for c in docs.columns if c != "text"]
    return docs.select(*columns, F.struct(*rest).alias("rest"))


def unwrapped(rows: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs``, with ``text`` and its length."""
    columns = [text.alias("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]
    whole = rows.select(*columns)
    if "n_chars" not in docs.columns:
        return whole
    kind = docs.schema["n_chars"].dataType
    return whole.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, run with at most ``BATCH_ROWS`` rows in an Arrow batch. The setting stays, as results are lazy."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"

    @wraps(stage)
    def of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
            spark.conf.set(setting, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return of


def left_over(changed: Column, text: Column) -> Column:
    """Whether a document stays: unchanged ones do, changed ones if a letter or digit is left."""
    return ~changed | text.rlike(r"[\p{L}\p{N}]")


@in_small_batches
def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fitted(docs.select("doc_id", "text", "lang").filter(fold("doc_id", FOLDS) != HELD_OUT))
    if model is None:
        return docs
    found = language.languages(wrapped(docs, "doc_id", "text"), model)
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_confidence") >= LEAST_CONFIDENCE))
    return unwrapped(kept, docs, F.col("text"))


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row is known by two hashes of all its columns; the groups' chosen rows are joined back by them.

    Only ids and hashes are grouped, so no group is gathered anywhere.
    """
    values = [x for c in docs.columns for x in (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")), F.col(f"`{c}`").isNull())]
    hashes = F.xxhash64(*values).alias("content"), F.hash(*values).alias("check")
    rows = wrapped(docs, "doc_id", "text", *hashes)
    linked = simhash.linked_documents(
        rows.select("doc_id", "text", "content", "check"), shingle=SHINGLE, radius=MOST_BITS, keep=("content", "check")
    )
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "content", "check")).alias("first")
    chosen = linked.groupBy("component").agg(first).select("first.content", "first.check")
    same = W.partitionBy("content", "check").orderBy("content")
    once = rows.join(chosen, ["content", "check"]).withColumn("nth", F.row_number().over(same)).filter("nth = 1")
    return unwrapped(once, docs, F.col("text"))


@in_small_batches
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substring_dedup.deduplicated(wrapped(docs, "doc_id", "text"), as_text=True)
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept"))
    return unwrapped(found.filter(left_over(F.col("n_removed") > 0, text)), docs, text)


@in_small_batches
def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(wrapped(docs, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    text = decontaminate.without_spans(F.col("text"), F.col("spans"))
    return unwrapped(found.filter(left_over(F.col("n_hit") > 0, text)), docs, text)


@in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, TOKENS)
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_substrings", cut_repeats),
    ("benchmark_overlap", cut_benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
