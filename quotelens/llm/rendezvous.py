"""Sharding by rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HASH_BITS = 52


def draw(key: Column, name: int) -> Column:
    """A number in (0, 1) that depends on key and shard name only: 52 bits of md5."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{name}"))
    return (F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("double") + 0.5) / F.lit(float(2**HASH_BITS))


def choose(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose score -weight / ln(draw) is highest; ties go to the lower shard.

    A shard's scores do not depend on the other shards, so a shard that is added
    only takes records, one that is removed only gives its own, and a changed
    weight moves records to or from that shard alone.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    scores = F.array(*[F.lit(-float(w)) / F.log(draw(key, i)) for i, w in enumerate(weights)])
    return F.array_position(scores, F.array_max(scores)).cast("int") - 1


def shard_rows(
    docs: DataFrame, key: str, text: str, weights: Sequence[float], added_weight: float | None = None, cells: int = 256
) -> DataFrame:
    """Adds shard, grown_shard (with one more shard) and slot, a gapless place within the shard.

    Rows of a shard are numbered in the order of (cell, key, size, crc): a cell is a
    hashed part of the shard, of which there are `cells` in each, so a shard is
    never sorted in one task. Cells start where the counted rows of the lower ones
    end. Choose `cells` so that a cell fits a task. A null key is a key of its own
    (as the empty string), a null text has no bytes. Rows that repeat a key share a
    shard and get slots of their own.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text).cast("binary"), F.lit(b""))).alias("text_crc32"),
    )
    grown = F.lit(None).cast("int") if added_weight is None else choose(F.col("key"), [*weights, added_weight])
    # Crc and size join the cell's hash, so that even rows which repeat one key spread.
    named = F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("text_crc32"), F.col("size"))
    cell = F.pmod(F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("long"), F.lit(cells)).cast("int")
    rows = rows.select("*", choose(F.col("key"), weights).alias("shard"), grown.alias("grown_shard"), cell.alias("cell"))
    counted = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # At most shards x cells rows.
    placed = rows.join(F.broadcast(starts), ["shard", "cell"])
    within = Window.partitionBy("shard", "cell").orderBy("key", "size", "text_crc32")
    return placed.select(
        F.col("key").alias(key), "size", "text_crc32", "shard",
        (F.col("start") + F.row_number().over(within) - 1).alias("slot"), "grown_shard",
    )


def op6_rendezvous_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents over shards 0 to 15 of equal weight; the law is `key`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = shard_rows(docs, "doc_id", "text", [1.0] * 16, added_weight=1.0)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
