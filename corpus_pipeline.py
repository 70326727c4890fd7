"""The corpus pipeline: toxicity, near-duplicates, repeated lines, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet to the
shared folder and reads it again as the next stage's documents. All but the last return the columns
of their input. Rows a stage has no verdict on (no text, no id) are kept.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, odd_sketch, packing, secret_ledger, toxicity
from tidemark.llm.common import fresh
from tidemark.session import checkpoint_root

# No stage but the dedups can be told in SQL: see tests/llm.
ORACLE_SQL = None
# Words to a shingle for the near-duplicates of the pipeline.
SHINGLE = 5


def _resized(docs: DataFrame) -> DataFrame:
    """``n_chars``, where documents have it, follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the model is fitted to the labels of ``sf_dir``."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents of similarity 0.8 or more the one with the smallest id stays."""
    return odd_sketch.first_of_groups(docs, SHINGLE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has are cut out; every document stays, a null text stays null."""
    text, spans = fresh(docs, "own_text", "spans")
    kept = line_dedup.without_repeats(docs.withColumn(text, F.col("text")), text=text, spans=spans)
    cut = kept.withColumn("text", F.when(F.col("text").isNotNull(), F.col(text)))
    return _resized(cut.select(*docs.columns))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by [secret]; every document stays."""
    text, doc_id = fresh(docs, "scanned_text", "scanned_id")
    parts = docs.select(F.col("doc_id").alias(doc_id), F.col("text").alias(text), F.struct(*docs.columns).alias("row"))
    found = secret_ledger.with_findings(parts, secret_ledger.new_ledger(spark), doc_id, text)
    redacted = found.select("row.*", F.col("spans").alias(text)).withColumn(
        "text", secret_ledger.redacted(F.col("text"), F.col(text))
    )
    return _resized(redacted.select(*docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens, with their ids as little-endian 32-bit numbers."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_lines", drop_repeated_lines),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/{name}")
    return docs
