"""The catalogue: one entry per state describing its cube."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quotelens import fixed_values as fixed
from quotelens.config import MarketConfig
from quotelens.functions import payplan
from quotelens.functions.bins import month_label
from quotelens.operators.collapse import unmapped
from quotelens.schemas import CATALOGUE_ENTRY, CATALOGUE_FILE


def state_index(cube: DataFrame, config: MarketConfig) -> DataFrame:
    """Rows, months, companies, counties and settings per state.

    Meant for a folded cube, whose lists are short.
    """
    listed = cube.groupBy("State").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sort_array(F.collect_set("YYYYMM")).alias("months"),
        F.sort_array(F.collect_set("CompanyName")).alias("companies"),
        F.sort_array(F.collect_set("County")).alias("counties"),
    )
    state = F.col("state")
    return listed.withColumnRenamed("State", "state").select(
        "state", "rows", "months", "companies", "counties",
        state.isin(list(config.company_names)).alias("curated"),
        config.comparison_for(state).alias("comparison_company"),
        config.ours_for(state).alias("our_companies"),
    )


def displayable(index: DataFrame) -> DataFrame:
    """Entries of the states a report can be shown for."""
    return index.where(F.size("our_companies") > 0)


def upsert_index(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Replace the entries of the states in `fresh` and keep the others; both have one row per state."""
    return existing.join(F.broadcast(fresh.select("state")), "state", "left_anti").unionByName(fresh)


def index_json(index: DataFrame, generated_at: Column, source: str) -> DataFrame:
    """The whole catalogue as one JSON document; it has one entry per state."""
    entry = F.struct(*[F.col(name) for name in CATALOGUE_ENTRY.fieldNames()])
    states = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("state").alias("key"), entry.alias("value")))))
    return index.agg(states.alias("states")).select(
        F.to_json(
            F.struct(generated_at.alias("generated_at"), F.lit(source).alias("source"), F.col("states")),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )


def parse_index(text: DataFrame) -> DataFrame:
    """Entries of a catalogue document; none if it cannot be read."""
    parsed = text.select(F.from_json("value", CATALOGUE_FILE).alias("file"))
    return parsed.select(F.explode("file.states").alias("key", "entry")).select("entry.*")


def distinct_pay_plans(cube: DataFrame) -> DataFrame:
    """Plans present per state, in display order."""
    return (
        cube.where(F.col("PayPlan").isNotNull()).select("State", "PayPlan").distinct()
        .withColumn("PlanOrder", payplan.pay_plan_order(F.col("PayPlan")))
        .where(F.col("PlanOrder").isNotNull())
        .orderBy("State", "PlanOrder")
    )


def distinct_counties(cube: DataFrame) -> DataFrame:
    """Counties present per state: alphabetical, Other last."""
    return (
        cube.where(F.col("County").isNotNull()).select("State", "County").distinct()
        .orderBy("State", F.col("County") == fixed.OTHER, F.collate("County", "UNICODE"))
    )


def named_companies(companies: Column) -> Column:
    """How many companies of a list are neither Other nor shown by id."""
    return F.size(F.filter(companies, lambda c: ~c.rlike("^Other") & ~unmapped(c)))


def top_stats(index: DataFrame, report_rows: DataFrame) -> DataFrame:
    """Headline per state: quotes in the slice, month span, named companies."""
    quotes = report_rows.groupBy(F.col("State").alias("state")).agg(F.sum("Quotes").alias("TotalQuotes"))
    return index.join(quotes, "state", "left").select(
        F.col("state").alias("State"),
        F.coalesce("TotalQuotes", F.lit(0.0)).alias("TotalQuotes"),
        month_label(F.element_at("months", 1)).alias("FirstMonth"),
        month_label(F.element_at("months", -1)).alias("LastMonth"),
        F.size("months").alias("MonthCount"),
        named_companies(F.col("companies")).alias("NamedCompanies"),
    )


def selector_values() -> dict[str, list]:
    """Choices of the report's fixed selectors, in display order."""
    low, high = fixed.CREDIT_RANGE
    any_of = lambda values: ["Any", *values]
    return {
        "premium": list(range(0, fixed.PREMIUM_CAP + fixed.PREMIUM_STEP + 1, fixed.PREMIUM_STEP)),
        "credit": list(range(low, high + 1, fixed.CREDIT_STEP)),
        "liab": any_of(fixed.LIABILITY_LIMITS.values()),
        "term": [6, 12],
        "non_owner": any_of(["No", "Yes"]),
        "prior_insurance": any_of(["No", "Yes"]),
        "num_drivers": any_of(["1", "2", "3", "4+"]),
        "num_vehicles": any_of(["1", "2", "3", "4", "5+"]),
        "year_bin": any_of(label for _, _, label in fixed.VEHICLE_YEAR_BINS),
        "provider": list(fixed.PROVIDERS),
    }
