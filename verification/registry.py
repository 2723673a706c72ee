"""Every query by name: the library's operators on the mapped test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quotelens import fixed_values as fixed
from quotelens.functions import bins, credit, payplan
from quotelens.operators import catalog, collapse, cube as cubes, drivers, months, rates, report, vehicles
from quotelens.operators.report import ReportFilters
from quotelens.functions.lookup import dollars, total
from quotelens.schemas import COUNT_MEASURES, CUBE_KEYS, MEASURES, SLICE
from quotelens.sources.facts import fetch_table, in_slices, read_facts, scan_slices
from quotelens.sources.store import CubeStore
from verification.mapping import CONFIG, mapped_facts
from verification.scratch import cube_store, folded_months, scratch_root, stored_facts

Query = Callable[[SparkSession, str], DataFrame]

RATE_ROW = [*SLICE, "PolicyLinkID", "RateId", "CompanyId", "RateIteration"]
JOINED_KEY = [*SLICE, "PolicyLinkID", "RateId", "CompanyName", "PayPlan"]
CAR_ROW = [*SLICE, "RateLinkID", "RateVehicleId"]
RATIOS = ["SizePct", "AvgPremium", "BridgeRate", "AvgBridgingPremium", "VsCompareCo", "VsSIC"]

FILTERED = ReportFilters(
    month_from=202501, month_to=202503, premium_min=1000, premium_max=5000, term=12, liab="50/100",
    num_drivers="4+", prior_insurance=True, non_owner=False,
)
CREDIT_RANGE = ReportFilters(credit_min=900, credit_max=1200)
ONE_PLAN = ReportFilters(pay_plan="Full pay", num_vehicles="1", year_bin="2020+")
WHAT_IF = {"LiabBI": 10, "Comp": 25, "Coll": -15, "UninsPD": 150}


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, dates as text and arrays as joined text, for comparison."""
    columns = []
    for f in rows.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        columns.append(column.alias(f.name))
    return rows.select(*columns)


def rounded(rows: DataFrame) -> DataFrame:
    """Sums to four and ratios to eight decimals, for figures that are not sums of whole cents."""
    digits = {"SumPremium": 4, "SumBridgingPremium": 4, **dict.fromkeys(RATIOS, 8)}
    return rows.withColumns({c: F.round(c, n) for c, n in digits.items() if c in rows.columns})


# --- facts -----------------------------------------------------------------

def _scan(name: str) -> Query:
    return lambda spark, sf: plain(fetch_table(mapped_facts(spark, sf, name)[name], name, "IL", "202501"))


def _scan_stored(name: str) -> Query:
    """All slices of a stored fact table, each found by its folder among the quotes."""

    def scan(spark, sf):
        root = stored_facts(spark, sf, "rate", name)
        # One row per slice.
        slices = [tuple(r) for r in scan_slices(spark, root).collect()]
        return plain(read_facts(spark, root)[name].where(in_slices(slices)))

    return scan


def prune_inactive(spark, sf):
    """A store of all states after its inactive ones were removed."""
    store = CubeStore(spark, f"{scratch_root(spark)}/quotelens-pruned-{uuid.uuid4().hex}")
    places = store.stage("states", _states(spark, sf))
    store.publish(store.snapshot(), states=places, entries=_index(spark, sf), source="parquet")
    store.prune_inactive(CONFIG)
    return plain(store.states())


def index_after_prune(spark, sf):
    """The catalogue that such a store is left with, read back from its document."""
    store = CubeStore(spark, f"{scratch_root(spark)}/quotelens-pruned-{uuid.uuid4().hex}")
    store.publish(store.snapshot(), states=store.stage("states", _states(spark, sf)), entries=_index(spark, sf))
    store.prune_inactive(CONFIG)
    return plain(store.index())


def _rate(spark: SparkSession, sf: str) -> DataFrame:
    return mapped_facts(spark, sf, "rate")["rate"]


def _planned(spark: SparkSession, sf: str) -> DataFrame:
    """All quotes with repaired percent and plan, the stated percent beside them."""
    return rates.with_pay_plan(_rate(spark, sf).withColumn("RawPercent", F.col("PercentDown")))


def _known_plans(spark: SparkSession, sf: str) -> DataFrame:
    return _planned(spark, sf).where(F.col("PayPlan").isNotNull())


def discover_state_months(spark, sf):
    return months.discover_state_months(_rate(spark, sf))


def active_states(spark, sf):
    return months.only_active(discover_state_months(spark, sf), CONFIG, "State_Name")


def filter_rated_month(spark, sf):
    return plain(rates.in_rated_month(_rate(spark, sf)).select(*RATE_ROW, "RatedDate"))


def drop_inconsistent_policies(spark, sf):
    return rates.drop_inconsistent_policies(_rate(spark, sf)).select(*RATE_ROW, "NonOwner", "AssumedCredit")


def percent_down_normalize(spark, sf):
    normal = payplan.merged_hundredths(payplan.percent_tenths(F.col("PercentDown"))) / F.lit(100.0)
    return _planned(spark, sf).select(*RATE_ROW, "PercentDown", normal.alias("NormalPercent"))


def earliest_quote(spark, sf):
    columns = [*rates.QUOTE, "RateId", "RateIteration", "TotalPremium", "Term"]
    return plain(rates.earliest_quote(_known_plans(spark, sf)).select(*columns))


def company_name(spark, sf):
    return rates.with_company_name(_rate(spark, sf), CONFIG).select(*RATE_ROW, "CompanyName")


def county_clean(spark, sf):
    car = mapped_facts(spark, sf, "car")["car"]
    return car.select(*CAR_ROW, bins.clean_county(F.col("County")).alias("County"))


def liability_label(spark, sf):
    car = vehicles.with_liability_label(mapped_facts(spark, sf, "car")["car"])
    return car.select(*CAR_ROW, "LiabLimits1", "LiabLimits2", "LiabLimits")


def drop_invalid_liability_rates(spark, sf):
    return vehicles.drop_invalid_rates(mapped_facts(spark, sf, "car")["car"]).select(*CAR_ROW, "LiabLimits")


def driver_at_fault(spark, sf):
    facts = mapped_facts(spark, sf, "driver", "violation")
    flagged = drivers.driver_at_fault(facts["driver"], facts["violation"])
    return flagged.select(*SLICE, "RateLinkID", "RateDriverId", "Relation", "AtFault")


def driver_profile(spark, sf):
    facts = mapped_facts(spark, sf, "driver", "violation")
    return drivers.driver_profile(facts["driver"], facts["violation"])


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    facts = mapped_facts(spark, sf, "rate", "car", "driver")
    return cubes.rate_car_driver(facts["rate"], facts["car"], facts["driver"], CONFIG)


def rate_car_driver(spark, sf):
    amounts = [
        dollars(F.col(name)).alias(f"{c}Premium")
        for c, name in zip(fixed.COVERAGES, vehicles.COVERAGE_CENTS)
    ]
    return plain(_joined(spark, sf).select(
        *JOINED_KEY, "PurchasedFinal", "TotalPremium", "LiabLimits", "County", "VehicleCount", "Year",
        "PriorInsurance", "DriverCount", "NamedInsuredAge", "ResidencyStatus", "PriorMonthsCovg",
        "PriorDaysLapse", *amounts,
    ))


def premium_bin(spark, sf):
    row = _joined(spark, sf)
    return plain(row.select(*JOINED_KEY, "TotalPremium", bins.premium_bin(F.col("TotalPremium")).alias("PremBin")))


def year_bin(spark, sf):
    return _joined(spark, sf).select(*JOINED_KEY, "Year", bins.vehicle_year_bin(F.col("Year")).alias("YearBin"))


def _with_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    return cubes.with_profile_dimensions(_joined(spark, sf), CONFIG)


def credit_components(spark, sf):
    parts = cubes.with_credit_parts(_joined(spark, sf).withColumn("rated_year", F.year("RatedDate")))
    return parts.select(*JOINED_KEY, *credit.COMPONENTS)


# --- cubes -----------------------------------------------------------------

def monthly_cube(spark, sf):
    facts = mapped_facts(spark, sf, "rate", "car", "driver", by_policy=True)
    return plain(cubes.monthly_cube(facts["rate"], facts["car"], facts["driver"], CONFIG))


def _monthly(spark: SparkSession, sf: str) -> DataFrame:
    return cube_store(spark, sf, folded=False).monthly()


def _states(spark: SparkSession, sf: str) -> DataFrame:
    return cube_store(spark, sf).states()


def union_months(spark, sf):
    """An older part, from before county, credit and provider were dimensions, and a newer one."""
    cube = _monthly(spark, sf)
    keys = [k for k in CUBE_KEYS if k not in ("County", "CreditBin", "RateSource")]
    older = cube.where("YYYYMM <= 202502").groupBy(*keys).agg(
        *[(F.sum(m) if m in COUNT_MEASURES else total(m)).alias(m) for m in MEASURES])
    return plain(months.union_months(older, cube.where("YYYYMM > 202502")))


def upsert_months(spark, sf):
    """A stale store, its quotes doubled, in which the later months are replaced."""
    cube = _monthly(spark, sf)
    stale = cube.where("YYYYMM <= 202503").withColumn("Quotes", F.col("Quotes") * 2)
    return plain(months.upsert_months(stale, cube.where("YYYYMM >= 202503")))


def retained_months(spark, sf):
    cube = _monthly(spark, sf)
    return plain(months.keep_other_months(cube, cube.where("YYYYMM >= 202503")))


def merge_folded(spark, sf):
    """A folded store of earlier months into which the later months are merged."""
    folded = folded_months(spark, sf, "YYYYMM < 202503")
    later = _monthly(spark, sf).where("YYYYMM >= 202503")
    return plain(collapse.merge_folded(folded, later, CONFIG, distinct=True))


def missing_months(spark, sf):
    stored = _monthly(spark, sf).where("YYYYMM < 202503")
    return months.missing_months(discover_state_months(spark, sf), stored)


# --- catalogue -------------------------------------------------------------

def _index(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.state_index(_states(spark, sf), CONFIG)


def upsert_index(spark, sf):
    """Entries of earlier months, of which the active states are replaced."""
    existing = catalog.state_index(_states(spark, sf).where("YYYYMM < 202503"), CONFIG)
    return plain(catalog.upsert_index(existing, months.only_active(_index(spark, sf), CONFIG, "state")))


def index_json(spark, sf):
    return catalog.index_json(_index(spark, sf), F.lit("2026-01-01T00:00:00+00:00"), "parquet")


def month_label(spark, sf):
    stored = months.stored_months(_monthly(spark, sf))
    return stored.withColumn("MonthLabel", bins.month_label(F.col("YYYYMM")))


def top_stats(spark, sf):
    return catalog.top_stats(_index(spark, sf), report.report_rows(_states(spark, sf), CONFIG))


# --- report ----------------------------------------------------------------

def _sliced(filters: ReportFilters) -> Query:
    return lambda spark, sf: plain(report.slice_cube(_states(spark, sf), filters))


def slice_provider(spark, sf):
    """What each choice of provider lets through."""
    cube = _states(spark, sf)
    counted = [
        report.slice_cube(cube, ReportFilters(provider=provider)).agg(
            F.count(F.lit(1)).alias("CubeRows"), F.coalesce(F.sum("Quotes"), F.lit(0)).alias("Quotes"),
        ).select(F.lit(provider).alias("Provider"), "CubeRows", "Quotes")
        for provider in fixed.PROVIDERS
    ]
    return months.union_months(*counted)


def company_slice(spark, sf):
    return report.company_slice(report.slice_cube(_states(spark, sf), ReportFilters()), CONFIG)


def discount_what_if(spark, sf):
    sliced = report.slice_cube(_states(spark, sf), ReportFilters())
    return rounded(report.company_slice(sliced, CONFIG, WHAT_IF))


def _sums(filters: ReportFilters = ReportFilters()) -> Query:
    return lambda spark, sf: report.report_rows(_states(spark, sf), CONFIG, filters)


def market_share(spark, sf):
    return report.market_share(_sums()(spark, sf)).select("State", "CompanyName", "Quotes", "SizePct")


def company_ranks(spark, sf):
    ranked = report.company_ranks(report.company_metrics(_sums()(spark, sf)))
    return ranked.select("State", "CompanyName", "WrittenRank", "BridgeRank", "RankDiff")


def vs_reference(spark, sf):
    compared = report.vs_reference(report.company_metrics(_sums()(spark, sf)), CONFIG)
    return compared.select("State", "CompanyName", "AvgBridgingPremium", "VsCompareCo", "VsSIC")


def _report(filters: ReportFilters = ReportFilters(), discounts: dict | None = None) -> Query:
    return lambda spark, sf: report.company_report(_states(spark, sf), CONFIG, filters, discounts)


company_report = _report()


QUERIES: dict[str, Query] = {
    "company_report": company_report,
    "scan_rate": _scan("rate"),
    "scan_car": _scan("car"),
    "scan_driver": _scan("driver"),
    "scan_violation": _scan("violation"),
    "scan_stored_rate": _scan_stored("rate"),
    "scan_stored_car": _scan_stored("car"),
    "scan_stored_driver": _scan_stored("driver"),
    "scan_stored_violation": _scan_stored("violation"),
    "discover_state_months": discover_state_months,
    "state_months": lambda spark, sf: plain(months.state_months(discover_state_months(spark, sf))),
    "active_states": active_states,
    "filter_rated_month": filter_rated_month,
    "drop_inconsistent_policies": drop_inconsistent_policies,
    "percent_down_repair": lambda spark, sf: _planned(spark, sf).select(*RATE_ROW, "RawPercent", "PercentDown"),
    "percent_down_normalize": percent_down_normalize,
    "pay_plan": lambda spark, sf: _known_plans(spark, sf).select(*RATE_ROW, "PercentDown", "PaymentCount", "PayPlan"),
    "purchased_flag": lambda spark, sf: rates.purchased_flag(_known_plans(spark, sf)),
    "earliest_quote": earliest_quote,
    "company_name": company_name,
    "rate_clean": lambda spark, sf: plain(rates.clean_rates(_rate(spark, sf), CONFIG)),
    "county_clean": county_clean,
    "liability_label": liability_label,
    "drop_invalid_liability_rates": drop_invalid_liability_rates,
    "car_profile": lambda spark, sf: plain(vehicles.car_profile(mapped_facts(spark, sf, "car")["car"])),
    "driver_at_fault": driver_at_fault,
    "named_insured": lambda spark, sf: drivers.named_insured(mapped_facts(spark, sf, "driver")["driver"]),
    "driver_profile": driver_profile,
    "rate_car_driver": rate_car_driver,
    "premium_bin": premium_bin,
    "year_bin": year_bin,
    "cap_counts": lambda spark, sf: _with_dimensions(spark, sf).select(
        *JOINED_KEY, "DriverCount", "NumDrivers", "VehicleCount", "NumVehicles"),
    "credit_components": credit_components,
    "predicted_credit": lambda spark, sf: _with_dimensions(spark, sf).select(*JOINED_KEY, "PredictedCredit"),
    "credit_bin": lambda spark, sf: _with_dimensions(spark, sf).select(*JOINED_KEY, "PredictedCredit", "CreditBin"),
    "monthly_cube": monthly_cube,
    "union_months": union_months,
    "upsert_months": upsert_months,
    "retained_months": retained_months,
    "missing_months": missing_months,
    "company_top_n": lambda spark, sf: plain(collapse.company_top_n(_monthly(spark, sf), CONFIG)),
    "county_top_n": lambda spark, sf: plain(collapse.county_top_n(_monthly(spark, sf), CONFIG)),
    "state_cube": lambda spark, sf: plain(collapse.state_cube(_monthly(spark, sf), CONFIG)),
    "merge_folded": merge_folded,
    "prune_inactive": prune_inactive,
    "index_after_prune": index_after_prune,
    "state_index": lambda spark, sf: plain(_index(spark, sf)),
    "upsert_index": upsert_index,
    "index_json": index_json,
    "displayable_states": lambda spark, sf: catalog.displayable(_index(spark, sf)).select("state"),
    "distinct_pay_plans": lambda spark, sf: catalog.distinct_pay_plans(_states(spark, sf)),
    "distinct_counties": lambda spark, sf: catalog.distinct_counties(_states(spark, sf)),
    "month_label": month_label,
    "top_stats": top_stats,
    "slice_filter": _sliced(FILTERED),
    "slice_credit_range": _sliced(CREDIT_RANGE),
    "slice_provider": slice_provider,
    "company_slice": company_slice,
    "zero_fill_companies": _sums(FILTERED),
    "discount_what_if": discount_what_if,
    "company_metrics": lambda spark, sf: report.company_metrics(_sums()(spark, sf)),
    "market_share": market_share,
    "company_ranks": company_ranks,
    "vs_reference": vs_reference,
    "report_total": lambda spark, sf: report.report_total(_sums()(spark, sf), CONFIG),
    "company_report_filtered": _report(ONE_PLAN),
    "company_report_what_if": lambda spark, sf: rounded(_report(discounts=WHAT_IF)(spark, sf)),
    "report_sorted": lambda spark, sf: report.sort_report(company_report(spark, sf), "AvgPremium", ascending=False),
    "report_where": lambda spark, sf: company_report(spark, sf).where("Quotes > 300 AND NOT IsTotal"),
    "formatted_report": lambda spark, sf: report.formatted_report(company_report(spark, sf)),
}
