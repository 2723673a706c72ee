"""Vehicles of a quote: one row per rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quotelens import fixed_values as fixed
from quotelens.functions import bins
from quotelens.functions.lookup import cents, dollars, ordering
from quotelens.operators.joins import lookup_join
from quotelens.schemas import SLICE

RATE_LINK = ["RateLinkID", *SLICE]
COVERAGE_CENTS = [f"{c}Cents" for c in fixed.COVERAGES]


def with_liability_label(car: DataFrame) -> DataFrame:
    return car.withColumn("LiabLimits", bins.liability_label(F.col("LiabLimits1"), F.col("LiabLimits2")))


def drop_invalid_rates(car: DataFrame) -> DataFrame:
    """Vehicles of the rates on which every vehicle has a valid pair of limits."""
    labelled = with_liability_label(car).where(F.col("RateLinkID").isNotNull())
    invalid = labelled.where(F.col("LiabLimits").isNull()).select(*RATE_LINK).distinct()
    return lookup_join(labelled, invalid, RATE_LINK, "left_anti")


def vehicle_totals(car: DataFrame) -> DataFrame:
    """One row per valid rate, coverage sums in whole cents.

    Validity, the first vehicle and all sums come from a single aggregate. The
    first vehicle is the one with the lowest id.
    """
    vehicles = with_liability_label(car).where(F.col("RateLinkID").isNotNull())
    vehicles = vehicles.withColumns({
        "County": bins.clean_county(F.col("County")),
        **{name: cents(f"{c}Premium") for c, name in zip(fixed.COVERAGES, COVERAGE_CENTS)},
    })
    return (
        vehicles.groupBy(*RATE_LINK)
        .agg(
            F.max(F.col("LiabLimits").isNull()).alias("invalid"),
            F.min(ordering("RateVehicleId", "LiabLimits", "County")).alias("first"),
            F.count("Year").alias("VehicleCount"),
            F.max("Year").alias("Year"),
            *[F.expr(f"coalesce(sum({name}), 0)").alias(name) for name in COVERAGE_CENTS],
        )
        .where(~F.col("invalid"))
        .select(
            *SLICE, F.col("RateLinkID").alias("RateId"),
            F.col("first.LiabLimits").alias("LiabLimits"), F.col("first.County").alias("County"),
            "VehicleCount", "Year", *COVERAGE_CENTS,
        )
    )


def car_profile(car: DataFrame) -> DataFrame:
    """One row per valid rate: limits, county, vehicle count, newest year, coverage premiums."""
    amounts = [dollars(F.col(name)).alias(f"{c}Premium") for c, name in zip(fixed.COVERAGES, COVERAGE_CENTS)]
    return vehicle_totals(car).select(
        *SLICE, "RateId", "LiabLimits", "County", F.col("VehicleCount").alias("NumVehicles"), "Year", *amounts
    )
