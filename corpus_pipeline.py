"""Documents to training sequences: five stages, each written as a table before the next one reads it."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelens.llm import decontamination, language_id, minhash_dedup, packing, secret_scan
from quotelens.llm.common import shared_folder


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an accepted language; `lang` is what a document declares, `source` its host."""
    model = language_id.fit(docs, "doc_id", "text", "lang")
    found = language_id.identify(docs, "text", F.col("lang"), F.col("source"), model)
    return found.where("__accepted").select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates; of rows alike in doc_id and text, one. Rows without doc_id stay."""
    found = minhash_dedup.find_near_duplicates(docs, "doc_id", "text")
    key = ["doc_id", "__digest"]
    first = found.where("kept and doc_id is not null").select("doc_id", F.col("text_digest").alias("__digest")).distinct()
    told = docs.where("doc_id is not null").withColumn("__digest", minhash_dedup.text_digest("text"))
    kept = told.join(first, key, "left_semi").dropDuplicates(key).select(*docs.columns)
    return kept.union(docs.where("doc_id is null"))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item. What a text holds decides, so equal texts go together."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_contamination(docs, "doc_id", "text", items, "item_id", "text")
    hit = found.where(F.size("hit_from") > 0).select(F.col("text_digest").alias("__digest")).distinct()
    digest = F.unhex(F.substring(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256), 1, 32))
    return docs.withColumn("__digest", digest).join(hit, "__digest", "left_anti").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in a text replaced by a mark and n_chars counted anew where it was the length."""
    old_size = F.when(F.length("text") == F.col("n_chars"), True).otherwise(False)
    scanned = secret_scan.redact(docs.withColumn("__counted", old_size), "text")
    size = F.when(F.col("__counted"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return scanned.withColumn("n_chars", size).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 4096 tokens."""
    return packing.pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_languages),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_benchmarks),
    ("secret_scan", without_secrets),
    ("packing", sequences),
]

#: No SQL: languages, signatures and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
