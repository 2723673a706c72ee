"""Drivers of a quote: one row per rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quotelens import fixed_values as fixed
from quotelens.functions.lookup import ordering
from quotelens.operators.joins import lookup_join
from quotelens.schemas import SLICE

DRIVER_KEY = ["RateDriverId", *SLICE]
RATE_LINK = ["RateLinkID", *SLICE]
NAMED_INSURED = ["Age", "ResidencyStatus", "PriorMonthsCovg", "PriorDaysLapse"]


def at_fault_flags(violation: DataFrame) -> DataFrame:
    """Per driver, 1 if any violation was at fault."""
    return (
        violation.where(F.col("RateDriverLinkId").isNotNull())
        .groupBy(*SLICE, F.col("RateDriverLinkId").alias("RateDriverId"))
        .agg(F.coalesce(F.max(F.col("AtFault") != 0), F.lit(False)).cast("int").alias("AtFault"))
    )


def driver_at_fault(driver: DataFrame, violation: DataFrame) -> DataFrame:
    """Driver rows with their at-fault flag, 0 where no violation is known."""
    return lookup_join(driver, at_fault_flags(violation), DRIVER_KEY, "left").withColumn(
        "AtFault", F.coalesce("AtFault", F.lit(0))
    )


def _first_driver():
    """Sorts the named insured before the other drivers, then by driver id."""
    others = ~F.col("Relation").eqNullSafe(fixed.NAMED_INSURED_CODE)
    return F.min(F.struct(others.alias("other"), ordering("RateDriverId", *NAMED_INSURED).alias("row")))


def _named_insured_columns() -> list:
    renamed = {"Age": "NamedInsuredAge"}
    return [F.col(f"first.row.{name}").alias(renamed.get(name, name)) for name in NAMED_INSURED]


def named_insured(driver: DataFrame) -> DataFrame:
    """The named insured of every rate, or its first driver where none is marked."""
    return (
        driver.where(F.col("RateLinkID").isNotNull())
        .groupBy(*RATE_LINK)
        .agg(_first_driver().alias("first"))
        .select(*RATE_LINK, F.col("first.row.RateDriverId").alias("RateDriverId"), *_named_insured_columns())
    )


def driver_totals(driver: DataFrame) -> DataFrame:
    """One row per rate: any prior insurance, driver count and named-insured columns."""
    return (
        driver.where(F.col("RateLinkID").isNotNull())
        .groupBy(*RATE_LINK)
        .agg(
            F.coalesce(F.max(F.col("PriorInsurance") != 0), F.lit(False)).cast("int").alias("PriorInsurance"),
            F.count("RateDriverId").alias("DriverCount"),
            _first_driver().alias("first"),
        )
        .select(
            *SLICE, F.col("RateLinkID").alias("RateId"), "PriorInsurance", "DriverCount", *_named_insured_columns()
        )
    )


def driver_profile(driver: DataFrame, violation: DataFrame) -> DataFrame:
    """One row per rate, including whether any driver was at fault.

    Only drivers with an at-fault violation are joined back, and only their
    keys, so the wide driver rows are shuffled once.
    """
    at_fault = at_fault_flags(violation).where(F.col("AtFault") == 1).drop("AtFault")
    fault_rates = (
        lookup_join(
            driver.where(F.col("RateLinkID").isNotNull()).select(*RATE_LINK, "RateDriverId"),
            at_fault, DRIVER_KEY, "left_semi",
        )
        .groupBy(*SLICE, F.col("RateLinkID").alias("RateId"))
        .agg(F.lit(1).alias("AtFault"))
    )
    return (
        driver_totals(driver)
        .join(fault_rates, [*SLICE, "RateId"], "left")
        .withColumn("AtFault", F.coalesce("AtFault", F.lit(0)))
        .withColumnRenamed("DriverCount", "NumDrivers")
    )
