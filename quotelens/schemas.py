"""Column types of the four fact tables, the cube and the catalogue."""

from __future__ import annotations

from pyspark.sql import types as T

from quotelens import fixed_values as fixed

MONEY = T.DecimalType(12, 2)        # one quote or vehicle
TOTAL = T.DoubleType()              # one cube cell; summed by whole cents

SLICE = ["State_Name", "Year_Month"]
SLICE_FIELDS = [T.StructField(name, T.StringType()) for name in SLICE]


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RATE = _struct(
    PolicyLinkID=T.LongType(), RateId=T.LongType(), CompanyId=T.LongType(),
    RateIteration=T.IntegerType(), RatedDate=T.DateType(),
    TotalPremium=MONEY, DownPayment=MONEY, PercentDown=T.DoubleType(),
    NumOfPayments=T.IntegerType(), Purchased=T.IntegerType(), NonOwner=T.IntegerType(),
    AssumedCredit=T.IntegerType(), Term=T.IntegerType(), Rate_Source=T.StringType(),
)
CAR = _struct(
    RateLinkID=T.LongType(), RateVehicleId=T.LongType(),
    LiabLimits1=T.IntegerType(), LiabLimits2=T.IntegerType(),
    Year=T.IntegerType(), County=T.StringType(),
    **{f"{c}Premium": MONEY for c in fixed.COVERAGES},
)
DRIVER = _struct(
    RateLinkID=T.LongType(), RateDriverId=T.LongType(), PriorInsurance=T.IntegerType(),
    Age=T.IntegerType(), Relation=T.StringType(), ResidencyStatus=T.StringType(),
    PriorMonthsCovg=T.IntegerType(), PriorDaysLapse=T.IntegerType(),
)
VIOLATION = _struct(RateDriverLinkId=T.LongType(), AtFault=T.IntegerType())

FACTS = {"rate": RATE, "car": CAR, "driver": DRIVER, "violation": VIOLATION}

#: Columns that every stored file must have. A fact without one of them would drop out, or count wrongly, in silence;
#: any other column that a file lacks is null there.
NEEDED = {
    "rate": ["PolicyLinkID", "RateId", "CompanyId", "RateIteration", "RatedDate", "TotalPremium", "DownPayment",
             "PercentDown", "NumOfPayments", "Purchased"],
    "car": ["RateLinkID", "RateVehicleId", "LiabLimits1", "LiabLimits2", "Year"],
    "driver": ["RateLinkID", "RateDriverId"],
    "violation": ["RateDriverLinkId", "AtFault"],
}


def fact_schema(table: str) -> T.StructType:
    """Columns of a fact table followed by its two partition columns."""
    return T.StructType(FACTS[table].fields + SLICE_FIELDS)


MONEY_MEASURES = ["SumPremium", "SumBridgingPremium", *[f"Sum{c}Premium" for c in fixed.COVERAGES]]
COUNT_MEASURES = ["Quotes", "BridgingCount"]
MEASURES = ["Quotes", "SumPremium", "BridgingCount", "SumBridgingPremium",
            *[f"Sum{c}Premium" for c in fixed.COVERAGES]]
CUBE_KEYS = ["State", "YYYYMM", *fixed.DIMENSIONS]

_INT_DIMENSIONS = {"PremBin", "NonOwner", "PriorInsurance", "Term", "CreditBin"}
CUBE = T.StructType(
    [T.StructField("State", T.StringType()), T.StructField("YYYYMM", T.IntegerType())]
    + [T.StructField(d, T.IntegerType() if d in _INT_DIMENSIONS else T.StringType()) for d in fixed.DIMENSIONS]
    + [T.StructField(m, T.LongType() if m in COUNT_MEASURES else TOTAL) for m in MEASURES]
)

CATALOGUE_ENTRY = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("months", T.ArrayType(T.IntegerType())),
    T.StructField("companies", T.ArrayType(T.StringType())),
    T.StructField("counties", T.ArrayType(T.StringType())),
    T.StructField("curated", T.BooleanType()),
    T.StructField("comparison_company", T.StringType()),
    T.StructField("our_companies", T.ArrayType(T.StringType())),
])
CATALOGUE_FILE = T.StructType([
    T.StructField("generated_at", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("states", T.MapType(T.StringType(), CATALOGUE_ENTRY)),
])
