"""Cleaning of the quote table: one row per policy, company and pay plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotelens.config import MarketConfig
from quotelens.functions import payplan
from quotelens.functions.lookup import ordering, small_table
from quotelens.operators.joins import lookup_join
from quotelens.schemas import SLICE

# Ids come first in every key: the sorts behind these aggregates and joins compare
# the leading column most cheaply, and an id decides nearly every comparison.
POLICY = ["PolicyLinkID", *SLICE]
QUOTE = ["PolicyLinkID", "CompanyId", *SLICE, "PayPlan"]

# Order that decides which quote of a key is the earliest: the iteration, then
# the lower premium, then every remaining column so that the pick never depends
# on the order rows arrive in.
EARLIEST = [
    "RateIteration", "TotalPremium", "RateId", "Term", "NonOwner", "Rate_Source", "RatedDate",
    "DownPayment", "PercentDown", "NumOfPayments", "Purchased", "AssumedCredit",
]
# The leading part of that order which the cube needs.
EARLIEST_FOR_CUBE = EARLIEST[:6]


def in_rated_month(rate: DataFrame) -> DataFrame:
    """Quotes rated in the month of their slice."""
    rated = F.year("RatedDate") * 100 + F.month("RatedDate")
    return rate.where(rated == F.col("Year_Month").try_cast("int"))


def _disagrees(column: str) -> Column:
    return F.coalesce(F.min(column) != F.max(column), F.lit(False))


def inconsistent_policies(rate: DataFrame) -> DataFrame:
    """Policies of a slice whose quotes disagree on NonOwner or AssumedCredit, nulls aside."""
    return (
        rate.where(F.col("PolicyLinkID").isNotNull())
        .groupBy(*POLICY)
        .agg((_disagrees("NonOwner") | _disagrees("AssumedCredit")).alias("disagrees"))
        .where("disagrees")
        .drop("disagrees")
    )


def drop_inconsistent_policies(rate: DataFrame) -> DataFrame:
    """All quotes but those of inconsistent policies; quotes without a policy stay."""
    return lookup_join(rate, inconsistent_policies(rate), POLICY, "left_anti")


def with_pay_plan(rate: DataFrame) -> DataFrame:
    """Repair PercentDown and add PaymentCount and PayPlan (null if not a known plan).

    Each step is a column of its own, so that it is computed once.
    """
    percent = payplan.repaired_percent(F.col("PercentDown"), F.col("DownPayment"), F.col("TotalPremium"))
    staged = (
        rate.withColumn("PercentDown", percent)
        .withColumns({
            "PaymentCount": payplan.payment_count(F.col("PercentDown"), F.col("NumOfPayments")),
            "tenths": payplan.percent_tenths(F.col("PercentDown")),
        })
        .withColumn("hundredths", payplan.merged_hundredths(F.col("tenths")))
    )
    plans = F.broadcast(payplan.pay_plans(rate.sparkSession))
    return staged.join(plans, ["hundredths", "PaymentCount"], "left").drop("tenths", "hundredths")


def purchased_flag(planned: DataFrame) -> DataFrame:
    """Whether any iteration of a policy, company and plan was purchased.

    Null for quotes without a policy or company, which belong to no key.
    """
    return planned.groupBy(*QUOTE).agg(_purchased().alias("PurchasedFinal"))


def _purchased() -> Column:
    keyed = F.col("PolicyLinkID").isNotNull() & F.col("CompanyId").isNotNull()
    return F.max(F.when(keyed, F.col("Purchased")))


def earliest_quote(planned: DataFrame, order: list[str] = EARLIEST) -> DataFrame:
    """The earliest iteration per policy, company and plan, lowest premium first.

    An aggregate instead of a window: it combines on the map side, so a key
    with very many iterations never gathers in one task.
    """
    kept = [F.col(f"first.{name}").alias(name) for name in order]
    return planned.groupBy(*QUOTE).agg(F.min(ordering(*order)).alias("first")).select(*QUOTE, *kept)


def with_company_name(rate: DataFrame, config: MarketConfig) -> DataFrame:
    """Add CompanyName: the mapped name of the state, else the id as text."""
    pairs = [(s, i, n) for s, names in config.company_names.items() for i, n in names.items()]
    own_id = F.col("CompanyId").cast("string")
    if not pairs:
        return rate.withColumn("CompanyName", own_id)
    # Bounded by the configuration: one small row per configured id.
    names = small_table(rate.sparkSession, ["State_Name", "CompanyId", "MappedName"], pairs)
    return (
        rate.join(F.broadcast(names), ["State_Name", "CompanyId"], "left")
        .withColumn("CompanyName", F.coalesce("MappedName", own_id))
        .drop("MappedName")
    )


def clean_rates(rate: DataFrame, config: MarketConfig, order: list[str] = EARLIEST) -> DataFrame:
    """Month filter, policy consistency, pay plan, purchase flag, earliest quote, name.

    Quotes are combined per policy, company and plan before anything else is
    shuffled. Quotes of other plans still count for consistency, so they travel
    along under a null plan and are dropped afterwards. What the policy window
    gathers is then bounded by companies times plans, however many quotes a
    policy has.
    """
    planned = with_pay_plan(in_rated_month(rate))
    combined = planned.groupBy(*QUOTE).agg(
        _purchased().alias("PurchasedFinal"),
        F.min(ordering(*order)).alias("first"),
        F.min("NonOwner").alias("owner_low"), F.max("NonOwner").alias("owner_high"),
        F.min("AssumedCredit").alias("credit_low"), F.max("AssumedCredit").alias("credit_high"),
    )
    policy = Window.partitionBy(*POLICY)

    def agrees(low: str, high: str) -> Column:
        return F.coalesce(F.min(low).over(policy) == F.max(high).over(policy), F.lit(True))

    consistent = F.col("PolicyLinkID").isNull() | (
        agrees("owner_low", "owner_high") & agrees("credit_low", "credit_high")
    )
    kept = [F.col(f"first.{name}").alias(name) for name in order]
    cleaned = (
        combined.withColumn("consistent", consistent)
        .where(F.col("consistent") & F.col("PayPlan").isNotNull())
        .select(*QUOTE, "PurchasedFinal", *kept)
    )
    return with_company_name(cleaned, config)
