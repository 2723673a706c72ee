"""Hand-written rows in the fact schemas; unnamed columns take plain defaults."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, types as T

from quotelens import fixed_values as fixed
from quotelens.schemas import CUBE, fact_schema

RATE_DEFAULTS = dict(
    PolicyLinkID=1, RateId=1, CompanyId=7000000, RateIteration=1, RatedDate=date(2025, 1, 5),
    TotalPremium=1200, DownPayment=1200, PercentDown=100.0, NumOfPayments=0, Purchased=0, NonOwner=0,
    AssumedCredit=1, Term=6, Rate_Source="ITC", State_Name="IL", Year_Month="202501",
)
CAR_DEFAULTS = dict(
    RateLinkID=1, RateVehicleId=1, LiabLimits1=25, LiabLimits2=50, Year=2022, County="Cook",
    State_Name="IL", Year_Month="202501", **{f"{c}Premium": 100 for c in fixed.COVERAGES},
)
DRIVER_DEFAULTS = dict(
    RateLinkID=1, RateDriverId=1, PriorInsurance=1, Age=40, Relation="I", ResidencyStatus="R",
    PriorMonthsCovg=12, PriorDaysLapse=0, State_Name="IL", Year_Month="202501",
)
VIOLATION_DEFAULTS = dict(RateDriverLinkId=1, AtFault=1, State_Name="IL", Year_Month="202501")
CUBE_DEFAULTS = dict(
    State="IL", YYYYMM=202501, CompanyName="UIC", PremBin=1000, LiabLimits="25/50", PayPlan="Full pay", NonOwner=0,
    NumDrivers="1", NumVehicles="1", County="COOK", PriorInsurance=1, YearBin="2020+", Term=6, CreditBin=900, RateSource="ITC",
    Quotes=1, SumPremium=1000.0, BridgingCount=0, SumBridgingPremium=0.0,
    **{f"Sum{c}Premium": 100.0 for c in fixed.COVERAGES},
)


def _frame(spark: SparkSession, schema: T.StructType, defaults: dict, rows: list[dict]) -> DataFrame:
    def value(field, row):
        given = {**defaults, **row}[field.name]
        return Decimal(str(given)) if isinstance(field.dataType, T.DecimalType) and given is not None else given

    for row in rows:
        unknown = set(row) - {f.name for f in schema.fields}
        assert not unknown, unknown
    return spark.createDataFrame([tuple(value(f, row) for f in schema.fields) for row in rows], schema)


def rate(spark, *rows):
    return _frame(spark, fact_schema("rate"), RATE_DEFAULTS, list(rows))


def car(spark, *rows):
    return _frame(spark, fact_schema("car"), CAR_DEFAULTS, list(rows))


def driver(spark, *rows):
    return _frame(spark, fact_schema("driver"), DRIVER_DEFAULTS, list(rows))


def violation(spark, *rows):
    return _frame(spark, fact_schema("violation"), VIOLATION_DEFAULTS, list(rows))


def cube(spark, *rows):
    return _frame(spark, CUBE, CUBE_DEFAULTS, list(rows))
