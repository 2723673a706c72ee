"""Joins that keep working when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join rows, possibly skewed on the key, to an aggregate with one row per key.

    An aggregate arrives already partitioned by the key, and adaptive execution
    only splits a hot partition when both inputs come straight from a shuffle.
    Spreading the lookup rows first gives them a shuffle of their own, so a hot
    key of `rows` is split over many tasks (or the lookup is broadcast, when its
    measured size allows that).
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.join(lookup.repartition(partitions), list(on), how)
