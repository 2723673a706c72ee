"""Labels and bins of the cube dimensions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quotelens import fixed_values as fixed
from quotelens.functions.lookup import first_match


def clean_county(county: Column) -> Column:
    """Upper case without surrounding whitespace of any kind; blank or null is UNKNOWN."""
    stripped = F.upper(F.regexp_replace(county, r"(?U)^\s+|\s+$", ""))
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit(fixed.UNKNOWN_COUNTY))


def liability_label(limit1: Column, limit2: Column) -> Column:
    """Label of a valid pair of limits, else null."""
    return first_match(
        [((limit1 == a) & (limit2 == b), label) for (a, b), label in fixed.LIABILITY_LIMITS.items()]
    )


def premium_bin(premium: Column) -> Column:
    """Lower bound of the premium step, capped above; below zero it rounds down."""
    capped = F.least(premium.cast("double"), F.lit(float(fixed.PREMIUM_CAP)))
    floor = (F.floor(capped / fixed.PREMIUM_STEP) * fixed.PREMIUM_STEP).cast("int")
    return F.when(premium.isNotNull(), floor)


def vehicle_year_bin(year: Column) -> Column:
    """Label of the right-closed year range, null outside all of them."""
    return first_match([((year > low) & (year <= high), label) for low, high, label in fixed.VEHICLE_YEAR_BINS])


def _capped_count(count: Column, cap: int) -> Column:
    return F.when(count.isNull(), "1").when(count >= cap, f"{cap}+").otherwise(count.cast("string"))


def driver_count_label(count: Column) -> Column:
    return _capped_count(count, fixed.MAX_DRIVERS)


def vehicle_count_label(count: Column) -> Column:
    return _capped_count(count, fixed.MAX_VEHICLES)


def provider(source: Column) -> Column:
    """The market provider of a quote or cube row; rows from before providers were told apart name none."""
    return F.coalesce(F.nullif(F.trim(source), F.lit("")), F.lit(fixed.LOADED_PROVIDER))


def month_label(month: Column) -> Column:
    """202405 -> 05/2024; anything but six digits is left as it is."""
    text = month.cast("string")
    return F.when(
        text.rlike(r"^[0-9]{6}$"), F.concat(F.substring(text, 5, 2), F.lit("/"), F.substring(text, 1, 4))
    ).otherwise(text)


def london_time_label(moment: Column) -> Column:
    """A UTC timestamp as wall-clock time in London."""
    local = F.from_utc_timestamp(moment, "Europe/London")
    return F.concat(F.date_format(local, "dd MMM yyyy, HH:mm"), F.lit(" (London time)"))
