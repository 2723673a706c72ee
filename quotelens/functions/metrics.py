"""Ratios and display formats of the company report."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def versus(value: Column, reference: Column) -> Column:
    """Relative difference to a positive reference, else null."""
    return F.when(reference > 0, value / reference - 1)


def _ties_away(value: Column, digits: int) -> Column:
    # format_number breaks exact ties to even; push them outwards. With no
    # decimals ties are odd halves, with one decimal they are odd quarters.
    parts = 2 if digits == 0 else 4
    scaled = value * parts
    tie = (scaled == F.floor(scaled)) & (F.abs(scaled % 2) == 1)
    return F.when(tie, value + F.signum(value) * 0.001).otherwise(value)


def grouped_number(value: Column) -> Column:
    return F.coalesce(F.format_number(_ties_away(value.cast("double"), 0), 0), F.lit(""))


def dollar_amount(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("$"), F.format_number(_ties_away(value.cast("double"), 0), 0)), F.lit(""))


def _one_decimal(value: Column) -> Column:
    return F.concat(F.translate(F.format_number(_ties_away(value, 1), 1), ",", ""), F.lit("%"))


def percent_text(percent: Column) -> Column:
    """A value that is already in percent."""
    return F.coalesce(_one_decimal(percent), F.lit(""))


def share_text(share: Column) -> Column:
    """A fraction of one, shown in percent."""
    return F.coalesce(_one_decimal(share * 100), F.lit(""))


def signed_share_text(share: Column) -> Column:
    """A fraction of one, shown in percent with its sign."""
    return F.coalesce(F.concat(F.when(share >= 0, "+").otherwise(""), _one_decimal(share * 100)), F.lit(""))


def signed_integer_text(value: Column) -> Column:
    return F.coalesce(F.concat(F.when(value > 0, "+").otherwise(""), value.cast("string")), F.lit(""))
