"""Slices that exist, are missing or get replaced."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quotelens.config import MarketConfig
from quotelens.functions.bins import provider

MONTH = ["State", "YYYYMM"]


def discover_state_months(rate: DataFrame, sample_percent: float | None = None) -> DataFrame:
    """The (State_Name, Year_Month) pairs of the quote table in order.

    Exact by default. With a percent in (0, 100] only a sample of the rows is
    looked at, which may miss small slices.
    """
    if sample_percent is not None:
        if not 0 < sample_percent <= 100:
            raise ValueError("sample_percent must be in (0, 100]")
        rate = rate.sample(sample_percent / 100, seed=1)
    return (
        rate.select(F.rtrim("State_Name").alias("State_Name"), F.rtrim("Year_Month").alias("Year_Month"))
        .dropna()
        .distinct()
        .orderBy("State_Name", "Year_Month")
    )


def state_months(slices: DataFrame) -> DataFrame:
    """Sorted distinct months per state; blank states or months are ignored."""
    trimmed = slices.select(F.trim("State_Name").alias("State"), F.trim("Year_Month").alias("Month"))
    return (
        trimmed.where((F.col("State") != "") & (F.col("Month") != ""))
        .groupBy("State")
        .agg(F.sort_array(F.collect_set("Month")).alias("months"))
    )


def stored_months(cube: DataFrame) -> DataFrame:
    return cube.select(*MONTH).distinct()


def missing_months(slices: DataFrame, stored: DataFrame) -> DataFrame:
    """Discovered slices that a cube does not hold yet."""
    found = slices.select(
        F.col("State_Name").alias("State"), F.col("Year_Month").try_cast("int").alias("YYYYMM")
    ).distinct()
    return found.join(stored_months(stored), MONTH, "left_anti")


def keep_other_months(cube: DataFrame, replaced: DataFrame) -> DataFrame:
    """Cube rows of the months that are not being replaced."""
    # One row per state and month code, however large the cube is.
    return cube.join(F.broadcast(stored_months(replaced)), MONTH, "left_anti")


def union_months(*parts: DataFrame) -> DataFrame:
    """Cube parts one below the other; columns an older part lacks become null."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def with_provider(cube: DataFrame) -> DataFrame:
    """Cube rows with their provider; months stored before it was a dimension, and rows without one, have the default."""
    source = F.col("RateSource") if "RateSource" in cube.columns else F.lit(None).cast("string")
    return cube.withColumn("RateSource", provider(source))


def upsert_months(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Replace the months that `fresh` holds and keep the others."""
    return union_months(keep_other_months(existing, fresh), fresh)


def only_active(rows: DataFrame, config: MarketConfig, state: str = "State") -> DataFrame:
    """Rows of the active states."""
    return rows.where(F.col(state).isin(list(config.active_states)))
