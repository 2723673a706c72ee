"""The monthly cube: thirteen dimensions, thirteen additive measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quotelens import fixed_values as fixed
from quotelens.config import MarketConfig
from quotelens.functions import bins, credit
from quotelens.functions.lookup import cents, dollars
from quotelens.operators.drivers import driver_totals
from quotelens.operators.joins import lookup_join
from quotelens.operators.rates import EARLIEST_FOR_CUBE, clean_rates
from quotelens.operators.vehicles import COVERAGE_CENTS, vehicle_totals
from quotelens.schemas import CUBE_KEYS, MEASURES, SLICE

RATE_KEY = ["RateId", *SLICE]
RATE_DIMENSIONS = ["CompanyName", "PremBin", "PayPlan", "NonOwner", "Term", "RateSource"]
PROFILE_DIMENSIONS = [
    "LiabLimits", "NumDrivers", "NumVehicles", "County", "PriorInsurance", "YearBin", "CreditBin",
]


def with_credit_parts(profile: DataFrame) -> DataFrame:
    """Add every component of the credit score; the rated year is in `rated_year`."""
    staged = profile.withColumns({
        "carrier": credit.carrier_state(F.col("PriorInsurance"), F.col("PriorDaysLapse")),
        "vehicle_age": F.col("rated_year") - F.col("Year"),
    })
    parts = {
        "CarrierPoints": credit.carrier_points(F.col("carrier")),
        "DurationPoints": credit.duration_points(F.col("PriorInsurance"), F.col("PriorMonthsCovg")),
        "VehicleAgePoints": credit.vehicle_age_points(F.col("vehicle_age")),
        "AgePoints": credit.age_points("NamedInsuredAge", "carrier"),
        "LimitsPoints": credit.limits_points(F.col("LiabLimits")),
        "VehicleCountPoints": credit.vehicle_count_points(F.col("VehicleCount")),
        "HomeownerPoints": credit.homeowner_points(F.col("ResidencyStatus")),
    }
    return staged.withColumns({name: points.cast("int") for name, points in parts.items()}).drop("carrier", "vehicle_age")


def rate_profile(car: DataFrame, driver: DataFrame) -> DataFrame:
    """Vehicles and drivers of every rate that has vehicles.

    Both sides are aggregates on the same key, so they meet without a further shuffle.
    """
    return (
        vehicle_totals(car).join(driver_totals(driver), RATE_KEY, "left")
        .withColumn("PriorInsurance", F.coalesce("PriorInsurance", F.lit(0)))
    )


def with_profile_dimensions(profile: DataFrame, config: MarketConfig) -> DataFrame:
    """Add PredictedCredit and the cube dimensions that depend on vehicles and drivers.

    Quotes are only kept in the month they were rated in, so the rated year is
    that of the slice.
    """
    scored = F.col("State_Name").isin(list(config.credit_states))
    score = credit.predicted_credit(
        F.col("NamedInsuredAge"), F.col("LiabLimits"), F.col("Year"), F.col("rated_year"))
    return (
        with_credit_parts(profile.withColumn("rated_year", F.substring("Year_Month", 1, 4).try_cast("int")))
        .withColumn("PredictedCredit", F.when(scored, score))
        .withColumns({
            "CreditBin": credit.credit_bin(F.col("PredictedCredit")),
            "YearBin": bins.vehicle_year_bin(F.col("Year")),
            "NumDrivers": bins.driver_count_label(F.col("DriverCount")),
            "NumVehicles": bins.vehicle_count_label(F.col("VehicleCount")),
        })
        .drop("rated_year", *credit.COMPONENTS)
    )


def rate_car_driver(rate: DataFrame, car: DataFrame, driver: DataFrame, config: MarketConfig) -> DataFrame:
    """Cleaned quotes with the vehicles and drivers of their rate, one row per quote."""
    return lookup_join(clean_rates(rate, config), rate_profile(car, driver), RATE_KEY, "inner")


def quotes_by_rate(cleaned: DataFrame) -> DataFrame:
    """Cleaned quotes combined per rate and rate-level dimension.

    Bounds what a rate shared by very many quotes brings into the join with the
    profiles. QuoteRows counts all quotes, Quotes those with a premium. Quotes are
    shuffled once, by the key of that join, and to a stated number of partitions, which
    adaptive execution leaves: their task holds the join and three aggregates too.
    """
    partitions = int(cleaned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    purchased = F.col("PurchasedFinal") == 1
    return (
        cleaned.withColumn("PremBin", bins.premium_bin(F.col("TotalPremium")))
        .withColumns({"NonOwner": F.coalesce("NonOwner", F.lit(0)), "RateSource": bins.provider(F.col("Rate_Source"))})
        .select(*RATE_KEY, *RATE_DIMENSIONS, "TotalPremium", "PurchasedFinal")
        .repartition(partitions, *RATE_KEY)
        .groupBy(*RATE_KEY, *RATE_DIMENSIONS)
        .agg(
            F.count(F.lit(1)).alias("QuoteRows"),
            F.count("TotalPremium").alias("Quotes"),
            F.coalesce(F.sum(cents("TotalPremium")), F.lit(0)).alias("PremiumCents"),
            F.coalesce(F.sum("PurchasedFinal"), F.lit(0)).alias("BridgingCount"),
            F.coalesce(F.sum(F.when(purchased, cents("TotalPremium"))), F.lit(0)).alias("BridgingCents"),
        )
    )


def monthly_cube(rate: DataFrame, car: DataFrame, driver: DataFrame, config: MarketConfig) -> DataFrame:
    """Aggregate all slices at once; null dimension values are kept as groups."""
    profile = with_profile_dimensions(rate_profile(car, driver), config)
    quotes = quotes_by_rate(clean_rates(rate, config, EARLIEST_FOR_CUBE))
    joined = quotes.join(profile.select(*RATE_KEY, *PROFILE_DIMENSIONS, *COVERAGE_CENTS), RATE_KEY)
    totals = joined.groupBy(
        F.col("State_Name").alias("State"), F.col("Year_Month").try_cast("int").alias("YYYYMM"), *fixed.DIMENSIONS
    ).agg(
        F.sum("Quotes").alias("Quotes"),
        dollars(F.sum("PremiumCents")).alias("SumPremium"),
        F.sum("BridgingCount").alias("BridgingCount"),
        dollars(F.sum("BridgingCents")).alias("SumBridgingPremium"),
        *[
            F.expr(f"sum(QuoteRows * {name}) / 100.0D").alias(f"Sum{c}Premium")
            for c, name in zip(fixed.COVERAGES, COVERAGE_CENTS)
        ],
    )
    return totals.select(*CUBE_KEYS, *MEASURES)
