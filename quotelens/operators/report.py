"""The company report on a stored cube."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from quotelens import fixed_values as fixed
from quotelens.config import MarketConfig
from quotelens.functions import metrics
from quotelens.functions.lookup import total

SLICE_SUMS = ["Quotes", "SumPremium", "BridgingCount", "SumBridgingPremium"]
REPORT_COLUMNS = [
    "State", "CompanyName", "Quotes", "SizePct", "AvgPremium", "WrittenRank", "BridgingCount", "BridgeRate",
    "AvgBridgingPremium", "BridgeRank", "RankDiff", "VsCompareCo", "VsSIC", "IsReference", "IsTotal",
]
SORTABLE = [c for c in REPORT_COLUMNS if c not in ("State", "CompanyName", "IsReference", "IsTotal")]


@dataclass(frozen=True)
class ReportFilters:
    """Choices of a report. None means Any; months are inclusive, as is the credit range.

    The upper premium bound is exclusive, so the default lets the top bin in.
    """

    month_from: int | None = None
    month_to: int | None = None
    premium_min: int = 0
    premium_max: int = fixed.PREMIUM_CAP + fixed.PREMIUM_STEP
    term: int = 6
    credit_min: int = fixed.CREDIT_RANGE[0]
    credit_max: int = fixed.CREDIT_RANGE[1]
    county: str | None = None
    liab: str | None = None
    pay_plan: str | None = None
    num_drivers: str | None = None
    num_vehicles: str | None = None
    year_bin: str | None = None
    non_owner: bool | None = None
    prior_insurance: bool | None = None
    provider: str = fixed.LOADED_PROVIDER


def slice_predicates(filters: ReportFilters, columns: list[str]) -> list[Column]:
    """Conditions of a report; a choice left at Any adds none."""
    conditions = [
        F.col("PremBin") >= filters.premium_min, F.col("PremBin") < filters.premium_max,
        F.col("Term") == filters.term,
    ]
    if filters.month_from is not None:
        conditions.append(F.col("YYYYMM") >= filters.month_from)
    if filters.month_to is not None:
        conditions.append(F.col("YYYYMM") <= filters.month_to)
    if (filters.credit_min, filters.credit_max) != fixed.CREDIT_RANGE:
        conditions.append(F.col("CreditBin").between(filters.credit_min, filters.credit_max))
    equal = {
        "County": filters.county, "LiabLimits": filters.liab, "PayPlan": filters.pay_plan,
        "NumDrivers": filters.num_drivers, "NumVehicles": filters.num_vehicles, "YearBin": filters.year_bin,
        "NonOwner": None if filters.non_owner is None else int(filters.non_owner),
        "PriorInsurance": None if filters.prior_insurance is None else int(filters.prior_insurance),
    }
    conditions += [F.col(name) == value for name, value in equal.items() if value is not None]
    if filters.provider != "Any":
        if "RateSource" in columns:
            conditions.append(F.col("RateSource") == filters.provider)
        elif filters.provider != fixed.LOADED_PROVIDER:
            conditions.append(F.lit(False))
    return conditions


def slice_cube(cube: DataFrame, filters: ReportFilters) -> DataFrame:
    """Cube rows a report is made of."""
    return cube.where(reduce(Column.__and__, slice_predicates(filters, cube.columns)))


def clean_discounts(discounts: Mapping[str, float] | None) -> dict[str, float]:
    """Percent per coverage: at most 100, not a number counts as 0, zeros left out; an unknown coverage is an error."""
    unknown = set(discounts or {}) - set(fixed.COVERAGES)
    if unknown:
        raise ValueError(f"no such coverage: {sorted(unknown)}")
    cleaned = {}
    for coverage in fixed.COVERAGES:
        percent = float((discounts or {}).get(coverage) or 0)
        percent = min(percent, 100.0) if math.isfinite(percent) else 0.0
        if percent:
            cleaned[coverage] = percent
    return cleaned


def company_slice(
    sliced: DataFrame, config: MarketConfig, discounts: Mapping[str, float] | None = None
) -> DataFrame:
    """Four sums per state and company, with what-if discounts for our companies.

    A discount takes its percent of a coverage off the written premium (a
    negative one adds to it); the purchased premium of a cube row shrinks in the
    same proportion. Written premium is linear in the sums and is adjusted after
    adding up; only the purchased premium needs the adjustment row by row.
    """
    active = clean_discounts(discounts)

    def off(amount) -> Column:
        return reduce(Column.__add__, [F.lit(p / 100) * amount(f"Sum{c}Premium") for c, p in active.items()])

    ours = config.is_ours(F.col("State"), F.col("CompanyName"))
    written, purchased = total("SumPremium"), total("SumBridgingPremium")
    if active:
        kept = 1 - F.try_divide(off(F.col), F.col("SumPremium"))
        bridged = F.col("SumBridgingPremium")
        # Each row at a fixed scale, so that the sum does not depend on their order.
        amount = F.when(ours & (F.col("SumPremium") > 0), kept * bridged).otherwise(bridged)
        purchased = F.sum(amount.cast("decimal(28,10)")).cast("double")
        # A grouping key decides who is discounted, so any row of the group can tell.
        written = written - F.when(F.max(ours), off(total)).otherwise(F.lit(0.0))
    return sliced.groupBy("State", "CompanyName").agg(
        F.sum("Quotes").cast("double").alias("Quotes"),
        written.alias("SumPremium"),
        F.sum("BridgingCount").cast("double").alias("BridgingCount"),
        purchased.alias("SumBridgingPremium"),
    )


def zero_fill(companies: DataFrame, sums: DataFrame) -> DataFrame:
    """All sums of the slice, and zeros for each listed company that has none.

    The list only adds rows: a company that it lacks, as a stale catalogue may, keeps
    its sums, and so does a company without a name, shown as UNKNOWN_COMPANY.
    """
    zeros = companies.select("State", "CompanyName", *[F.lit(0.0).alias(name) for name in SLICE_SUMS])
    every = sums.select("State", "CompanyName", *SLICE_SUMS).unionByName(zeros)
    named = F.coalesce("CompanyName", F.lit(fixed.UNKNOWN_COMPANY)).alias("CompanyName")
    return every.groupBy("State", named).agg(*[F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in SLICE_SUMS])


def _with_ratios(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "BridgeRate": metrics.ratio(F.col("BridgingCount"), F.col("Quotes")),
        "AvgPremium": metrics.ratio(F.col("SumPremium"), F.col("Quotes")),
        "AvgBridgingPremium": metrics.ratio(F.col("SumBridgingPremium"), F.col("BridgingCount")),
    })


def company_metrics(sums: DataFrame) -> DataFrame:
    """Purchase rate, average written and average purchased premium."""
    return _with_ratios(sums)


def _peers(rows: DataFrame) -> WindowSpec:
    """The companies of a state; TOTAL rows, where there are any, stand apart."""
    return Window.partitionBy("State", *(["IsTotal"] if "IsTotal" in rows.columns else []))


def market_share(sums: DataFrame) -> DataFrame:
    """Share of the state's quotes, in percent."""
    whole = F.sum("Quotes").over(_peers(sums))
    return sums.withColumn("SizePct", metrics.ratio(F.col("Quotes"), whole) * 100)


def company_ranks(rows: DataFrame) -> DataFrame:
    """Price ranks within the state, 1 is cheapest; ties share a rank, no average means no rank."""

    def rank(value: str) -> Column:
        cheapest = _peers(rows).orderBy(F.col(value).asc_nulls_last())
        return F.when(F.col(value).isNotNull(), F.rank().over(cheapest))

    ranked = rows.withColumns({"WrittenRank": rank("AvgPremium"), "BridgeRank": rank("AvgBridgingPremium")})
    return ranked.withColumn("RankDiff", F.col("WrittenRank") - F.col("BridgeRank"))


def vs_reference(rows: DataFrame, config: MarketConfig) -> DataFrame:
    """Average purchased premium relative to the comparison and the house company."""

    def reference(company: Column) -> Column:
        # The average of one company, beside every row of its state.
        is_reference = F.col("CompanyName") == company
        return F.max(F.when(is_reference, F.col("AvgBridgingPremium"))).over(_peers(rows))

    return (
        rows.withColumns({
            "RefCompare": reference(config.comparison_for(F.col("State"))),
            "RefHouse": reference(F.lit(config.house_company)),
        })
        .withColumn("VsCompareCo", metrics.versus(F.col("AvgBridgingPremium"), F.col("RefCompare")))
        .withColumn("VsSIC", metrics.versus(F.col("AvgBridgingPremium"), F.col("RefHouse")))
    )


def _added(amount: Column) -> Column:
    # As decimals, so that a total does not depend on the order of the companies.
    return F.sum(amount.cast("decimal(28,6)")).cast("double")


def _total_against(company: Column) -> Column:
    """Average purchased premium of all other companies relative to that of one."""
    is_it = F.coalesce(F.col("CompanyName") == company, F.lit(False))

    def average(rows: Column) -> Column:
        return metrics.ratio(
            _added(F.when(rows, F.col("SumBridgingPremium")).otherwise(0.0)),
            _added(F.when(rows, F.col("BridgingCount")).otherwise(0.0)),
        )

    return metrics.versus(average(~is_it), average(is_it))


def _total_comparisons(config: MarketConfig) -> dict[str, Column]:
    return {
        "VsCompareCo": _total_against(config.comparison_for(F.col("State"))),
        "VsSIC": _total_against(F.lit(config.house_company)),
    }


def report_total(sums: DataFrame, config: MarketConfig) -> DataFrame:
    """TOTAL row per state that has quotes.

    Its comparison columns put the average of all other companies against the
    reference company.
    """
    totals = sums.groupBy("State").agg(
        *[_added(F.col(name)).alias(name) for name in SLICE_SUMS],
        *[value.alias(name) for name, value in _total_comparisons(config).items()],
    )
    return (
        _with_ratios(totals.where(F.col("Quotes") > 0))
        .withColumn("CompanyName", F.lit("TOTAL"))
        .withColumn("SizePct", F.lit(100.0))
    )


def with_totals(sums: DataFrame, config: MarketConfig) -> DataFrame:
    """The sums and, from the same pass by grouping sets, a TOTAL row per state that has quotes.

    Comparisons of the TOTAL rows are in `TotalVsCompareCo` and `TotalVsSIC`.
    """
    levels = sums.groupingSets([["State", "CompanyName"], ["State"]], "State", "CompanyName").agg(
        (F.grouping("CompanyName") == 1).alias("IsTotal"),
        *[F.max(name).alias(name) for name in SLICE_SUMS],  # one row a company
        *[_added(F.col(name)).alias(f"Total{name}") for name in SLICE_SUMS],
        *[value.alias(f"Total{name}") for name, value in _total_comparisons(config).items()],
    )
    total = F.col("IsTotal")
    return levels.withColumns({
        "CompanyName": F.when(total, "TOTAL").otherwise(F.col("CompanyName")),
        **{name: F.when(total, F.col(f"Total{name}")).otherwise(F.col(name)) for name in SLICE_SUMS},
    }).where(~total | (F.col("Quotes") > 0)).drop(*[f"Total{name}" for name in SLICE_SUMS])


def report_rows(
    cube: DataFrame, config: MarketConfig, filters: ReportFilters = ReportFilters(),
    discounts: Mapping[str, float] | None = None, companies: DataFrame | None = None,
) -> DataFrame:
    """The zero-filled sums a report is derived from.

    A list of companies lets the scan read the slice alone. Without one, the same pass
    over the whole cube finds the companies and adds up the rows of the slice.
    """
    if companies is not None:
        return zero_fill(companies, company_slice(slice_cube(cube, filters), config, discounts))
    inside = reduce(Column.__and__, slice_predicates(filters, cube.columns))
    measures = dict.fromkeys([*SLICE_SUMS, *[f"Sum{c}Premium" for c in clean_discounts(discounts)]])
    whole = cube.withColumns({
        **{name: F.when(inside, F.col(name)) for name in measures},
        "CompanyName": F.coalesce("CompanyName", F.lit(fixed.UNKNOWN_COMPANY)),
    })
    sums = company_slice(whole, config, discounts)
    return sums.select("State", "CompanyName", *[F.coalesce(name, F.lit(0.0)).alias(name) for name in SLICE_SUMS])


def company_report(
    cube: DataFrame, config: MarketConfig, filters: ReportFilters = ReportFilters(),
    discounts: Mapping[str, float] | None = None, companies: DataFrame | None = None,
) -> DataFrame:
    """One row per company and a TOTAL per state, in display order.

    `companies` lists the companies to show (a catalogue has them); without it
    they are read off the cube.
    """
    sums = with_totals(report_rows(cube, config, filters, discounts, companies), config)
    rows = vs_reference(company_ranks(market_share(company_metrics(sums))), config)
    total = F.col("IsTotal")
    reference = F.coalesce(
        (F.col("CompanyName") == config.comparison_for(F.col("State")))
        | (F.col("CompanyName") == config.house_company),
        F.lit(False),
    )
    report = rows.withColumns({
        "IsReference": ~total & reference,
        "SizePct": F.when(total, 100.0).otherwise(F.col("SizePct")),
        **{name: F.when(~total, F.col(name)) for name in ("WrittenRank", "BridgeRank", "RankDiff")},
        **{n: F.when(total, F.col(f"Total{n}")).otherwise(F.col(n)) for n in ("VsCompareCo", "VsSIC")},
    })
    return report.select(*REPORT_COLUMNS).orderBy("State", *display_order())


def display_order() -> list[Column]:
    """Alphabetical by locale, Other after the named companies, TOTAL last."""
    return [
        F.col("IsTotal").asc(), F.col("CompanyName").rlike("^Other").asc(),
        F.collate("CompanyName", "UNICODE").asc(),
    ]


def sort_report(report: DataFrame, column: str, ascending: bool = True) -> DataFrame:
    """Sort by one figure within each state; TOTAL stays last."""
    if column not in SORTABLE:
        raise ValueError(f"not a sortable column: {column!r}")
    figure = F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()
    return report.orderBy("State", F.col("IsTotal").asc(), figure, *display_order()[1:])


def visible_columns(companies: list[str], comparison_company: str | None, house_company: str) -> list[str]:
    """Columns shown for a state: comparisons only where their company exists."""
    hidden = set()
    if not comparison_company:
        hidden.add("VsCompareCo")
    if house_company not in companies:
        hidden.add("VsSIC")
    return [c for c in REPORT_COLUMNS if c not in hidden]


def formatted_report(report: DataFrame) -> DataFrame:
    """The report as display text, missing values as empty text."""
    return report.select(
        "State", "CompanyName",
        metrics.grouped_number(F.col("Quotes")).alias("Quotes"),
        metrics.percent_text(F.col("SizePct")).alias("SizePct"),
        metrics.dollar_amount(F.col("AvgPremium")).alias("AvgPremium"),
        metrics.grouped_number(F.col("WrittenRank")).alias("WrittenRank"),
        metrics.grouped_number(F.col("BridgingCount")).alias("BridgingCount"),
        metrics.share_text(F.col("BridgeRate")).alias("BridgeRate"),
        metrics.dollar_amount(F.col("AvgBridgingPremium")).alias("AvgBridgingPremium"),
        metrics.grouped_number(F.col("BridgeRank")).alias("BridgeRank"),
        metrics.signed_integer_text(F.col("RankDiff")).alias("RankDiff"),
        metrics.signed_share_text(F.col("VsCompareCo")).alias("VsCompareCo"),
        metrics.signed_share_text(F.col("VsSIC")).alias("VsSIC"),
    )
