"""Token counts through a cache keyed by digests of content and tokenizer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelens.llm.common import shared_folder

CACHE_SCHEMA = "digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Digest of the vocabulary file and the library's version: other counts need another digest."""
    import tokenizers

    with open(path, "rb") as file:
        found = hashlib.sha256(file.read())
    found.update(f"tokenizers {tokenizers.__version__}, no special tokens added".encode())
    return found.hexdigest()


def cached_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer; a digest that was appended twice counts once."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(f"{cache}/tokenizer={version}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return rows.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def encoder(path: str):
    import pyarrow as pa

    from quotelens.llm.tokenizing import byte_counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = byte_counts(path)
        for batch in batches:
            counts = [count(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
            )

    return run


def count_tokens(docs: DataFrame, key: str, text: str, tokenizer: str, cache: str, limit: int = 1024) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row, encoding each text that the cache lacks once.

    Content is normalised only in ways that no count depends on: a null text is
    empty. Copies are merged in each task before texts are shuffled, so a text that
    many rows share is one row a task. The new counts are appended to the folder
    `cache`/tokenizer=<digest>; rows that two jobs append at once do no harm.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"), F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
        F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias("text"),
    )
    known = cached_counts(spark, cache, version)
    missing = rows.groupBy("digest").agg(F.first("text").alias("text")).join(known, "digest", "left_anti")
    missing.mapInArrow(encoder(tokenizer), CACHE_SCHEMA).write.mode("append").parquet(f"{cache}/tokenizer={version}")
    counted = rows.select("key", "digest", "n_bytes").join(cached_counts(spark, cache, version), "digest")
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of all documents. Each call starts a cache of its own, so that its work is always whole."""
    import uuid

    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cache = f"{shared_folder(spark)}/token-counts-{uuid.uuid4().hex}"
    return count_tokens(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), cache)
