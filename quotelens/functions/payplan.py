"""Down-payment percent, number of payments and the pay plan they name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quotelens import fixed_values as fixed
from quotelens.functions.lookup import first_match, small_table


def repaired_percent(percent: Column, down_payment: Column, premium: Column) -> Column:
    """Percent down, derived from the amounts where the field holds dollars (> 100).

    A derived percent is a whole number (ties to even) within 0..100, and 0
    where either amount is missing or the premium is zero.
    """
    share = F.try_divide(down_payment.cast("double"), premium.cast("double"))
    derived = F.least(F.greatest(F.coalesce(F.rint(share * 100), F.lit(0.0)), F.lit(0.0)), F.lit(100.0))
    return F.when(F.isnan(percent), None).when(percent > 100, derived).otherwise(percent)


def percent_tenths(percent: Column) -> Column:
    """Percent rounded to a tenth, ties to even, as whole tenths."""
    return F.rint(percent * 10).cast("int")


def merged_hundredths(tenths: Column) -> Column:
    """Whole hundredths of a percent, near values merged. One pass: a merged value is not merged again."""
    merged: dict[int, list[int]] = {}
    for near, target in fixed.MERGED_PERCENTS.items():
        merged.setdefault(round(target * 100), []).append(round(near * 10))
    return F.coalesce(
        first_match([(tenths.isin(near), target) for target, near in merged.items()]), tenths * 10
    ).cast("bigint")


def payment_count(percent: Column, further_payments: Column) -> Column:
    """One payment when exactly everything is paid down, else the down payment plus the rest.

    The test is on the percent before rounding: 99.99 keeps its payments.
    """
    return F.when(percent == 100.0, F.lit(1)).otherwise(further_payments + 1)


def pay_plans(spark: SparkSession) -> DataFrame:
    """The known plans: (hundredths, PaymentCount, PayPlan)."""
    rows = [(round(pct * 100), n, label) for pct, n, label in fixed.PAY_PLANS]
    return small_table(spark, ["hundredths", "PaymentCount", "PayPlan"], rows)


def pay_plan_order(label: Column) -> Column:
    """Position of a plan label in display order, from 0."""
    return first_match([(label == name, i) for i, (_, _, name) in enumerate(fixed.PAY_PLANS)])
