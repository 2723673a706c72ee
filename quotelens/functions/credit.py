"""Points-based credit prediction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quotelens import fixed_values as fixed
from quotelens.functions.lookup import first_match


def carrier_state(prior_insurance: Column, lapse_days: Column) -> Column:
    """NO_PC without prior insurance or with a negative lapse, else NO_LAPSE or LAPSE."""
    insured = F.coalesce(prior_insurance, F.lit(0)) == 1
    lapse = F.coalesce(lapse_days, F.lit(0))
    return F.when(insured & (lapse == 0), "NO_LAPSE").when(insured & (lapse > 0), "LAPSE").otherwise("NO_PC")


def carrier_points(state: Column) -> Column:
    return first_match([(state == name, points) for name, points in fixed.CARRIER_POINTS.items()], 0)


def duration_points(prior_insurance: Column, prior_months: Column) -> Column:
    """Points for months of earlier cover; none counts as zero months."""
    insured = F.coalesce(prior_insurance, F.lit(0)) == 1
    months = F.when(insured, F.coalesce(prior_months, F.lit(0))).otherwise(F.lit(0))
    return first_match([(months <= top, points) for top, points in fixed.DURATION_POINTS], fixed.LONG_DURATION_POINTS)


def vehicle_age_points(age: Column) -> Column:
    """Points for the age of the newest vehicle in years, 0 where it is unknown."""
    known = first_match([(age <= top, points) for top, points in fixed.VEHICLE_AGE_POINTS], fixed.OLD_VEHICLE_POINTS)
    return F.when(age.isNull(), 0).otherwise(known)


def age_points(age: str, state: str) -> Column:
    """Points for the named insured's age by carrier state, from the two column names."""
    bands = " ".join(
        f"WHEN {age} BETWEEN {low} AND {high} THEN CASE {state} "
        + " ".join(f"WHEN '{name}' THEN {points}" for name, points in by_state.items()) + " END"
        for low, high, by_state in fixed.AGE_POINTS
    )
    return F.expr(f"coalesce(CASE {bands} END, 0)")


def limits_points(limits: Column) -> Column:
    return first_match([(limits == label, points) for label, points in fixed.LIMITS_POINTS.items()], 0)


def vehicle_count_points(vehicles: Column) -> Column:
    """Points per vehicle up to the cap; takes the plain count."""
    return F.least(F.coalesce(vehicles, F.lit(1)), F.lit(fixed.MAX_VEHICLES)) * fixed.POINTS_PER_VEHICLE


def homeowner_points(residency: Column) -> Column:
    return F.when(residency == fixed.HOMEOWNER_CODE, fixed.HOMEOWNER_POINTS).otherwise(0)


COMPONENTS = [
    "CarrierPoints", "DurationPoints", "VehicleAgePoints", "AgePoints", "LimitsPoints", "VehicleCountPoints",
    "HomeownerPoints",
]


def predicted_credit(age: Column, limits: Column, newest_year: Column, rated_year: Column) -> Column:
    """Base score plus the component columns; null where one of the given inputs is missing."""
    score = F.expr(" + ".join([str(fixed.CREDIT_BASE), *COMPONENTS]))
    complete = age.isNotNull() & limits.isNotNull() & newest_year.isNotNull() & rated_year.isNotNull()
    return F.when(complete, score.cast("int"))


def credit_bin(score: Column) -> Column:
    """Lower bound of the score step."""
    return (F.floor(score / fixed.CREDIT_STEP) * fixed.CREDIT_STEP).cast("int")
