"""Folding of long tails: companies and counties outside the top of their state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotelens import fixed_values as fixed
from quotelens.config import MarketConfig
from quotelens.functions.lookup import cents, dollars, total
from quotelens.operators.months import upsert_months
from quotelens.schemas import COUNT_MEASURES, CUBE_KEYS, MEASURES


def regroup(cube: DataFrame) -> DataFrame:
    """Sum the measures of rows that have become equal in every dimension."""
    sums = [
        (F.coalesce(F.sum(m), F.lit(0)) if m in COUNT_MEASURES else total(m)).alias(m) for m in MEASURES
    ]
    return cube.groupBy(*CUBE_KEYS).agg(*sums)


def _top(volumes: DataFrame, name: str, limit: int, kept: Column) -> DataFrame:
    """The leading names per state by quotes, ties by name.

    The constant limit lets Spark cut each partition before the shuffle; the
    per-state number is applied within it.
    """
    order = Window.partitionBy("State").orderBy(F.desc("Volume"), F.asc(name))
    return (
        volumes.withColumn("position", F.row_number().over(order))
        .where((F.col("position") <= limit) & (F.col("position") <= kept))
        .select("State", name, F.lit(True).alias("kept"))
    )


def unmapped(company: Column) -> Column:
    """Companies shown by id."""
    return company.rlike(r"^[0-9]+$")


def top_companies(cube: DataFrame, config: MarketConfig) -> DataFrame:
    """Unmapped companies that stay on their own: (State, CompanyName, kept)."""
    volumes = (
        cube.where(unmapped(F.col("CompanyName"))).groupBy("State", "CompanyName").agg(F.sum("Quotes").alias("Volume"))
    )
    return _top(volumes, "CompanyName", fixed.TOP_COMPANIES_UNMAPPED, config.kept_companies(F.col("State")))


def top_counties(cube: DataFrame, config: MarketConfig) -> DataFrame:
    """Counties that stay on their own: (State, County, kept)."""
    volumes = (
        cube.where(F.col("County").isNotNull()).groupBy("State", "County").agg(F.sum("Quotes").alias("Volume"))
    )
    return _top(volumes, "County", config.top_counties, F.lit(config.top_counties))


def _relabel_companies(cube: DataFrame, config: MarketConfig) -> DataFrame:
    # At most TOP_COMPANIES_UNMAPPED rows per state, hence safe to broadcast.
    name = F.col("CompanyName")
    folds = (unmapped(name) & F.col("kept").isNull()) | (name == fixed.OTHER)
    return (
        cube.join(F.broadcast(top_companies(cube, config)), ["State", "CompanyName"], "left")
        .withColumn("CompanyName", F.when(folds, fixed.OTHER).otherwise(name))
        .drop("kept")
    )


def _relabel_counties(cube: DataFrame, config: MarketConfig) -> DataFrame:
    # At most top_counties rows per state, hence safe to broadcast.
    return (
        cube.join(F.broadcast(top_counties(cube, config)), ["State", "County"], "left")
        .withColumn("County", F.when(F.col("kept"), F.col("County")).otherwise(fixed.OTHER))
        .drop("kept")
    )


def company_top_n(cube: DataFrame, config: MarketConfig) -> DataFrame:
    """Fold unmapped companies outside the top of their state into Other."""
    return regroup(_relabel_companies(cube, config))


def county_top_n(cube: DataFrame, config: MarketConfig) -> DataFrame:
    """Fold counties outside the top of their state, and null ones, into Other."""
    return regroup(_relabel_counties(cube, config))


def merge_folded(folded: DataFrame, fresh: DataFrame, config: MarketConfig, distinct: bool = False) -> DataFrame:
    """Put fresh months into a cube that was folded before, and fold again.

    For stores that keep no unfolded cube. What was folded stays Other, so the
    result depends on the order of refreshes; `state_cube` on all months does not.
    `distinct` holds for both cubes, and then for what they make together: a month is of one of them.
    """
    return state_cube(upsert_months(folded, fresh), config, distinct)


def _regroup_folded(relabelled: DataFrame) -> DataFrame:
    """`regroup` of a cube that had one row per key before labels became Other.

    Only rows with a label Other can have become equal, so only they are shuffled. Rows
    without a state or month are regrouped too: those of several cubes may be equal.
    """
    counts = {m: F.coalesce(m, F.lit(0)) for m in COUNT_MEASURES}
    amounts = {m: dollars(F.coalesce(cents(m), F.lit(0))) for m in MEASURES if m not in COUNT_MEASURES}
    other = F.coalesce(F.col("CompanyName") == fixed.OTHER, F.lit(False)) | (F.col("County") == fixed.OTHER)
    gathered = other | F.col("State").isNull() | F.col("YYYYMM").isNull()
    alone = relabelled.where(~gathered).withColumns({**counts, **amounts}).select(*CUBE_KEYS, *MEASURES)
    return regroup(relabelled.where(gathered)).unionByName(alone)


def state_cube(cube: DataFrame, config: MarketConfig, distinct: bool = False) -> DataFrame:
    """Fold companies and counties of all months together.

    Folding companies leaves county volumes as they are, so both lists come
    from the same cube and the rows are regrouped once. Give it a stored cube:
    it is read three times, and once more if it is `distinct`, that is, has one
    row per key, as a stored cube has; then only rows that fold are shuffled.
    """
    counties = F.broadcast(top_counties(cube, config))
    relabelled = (
        _relabel_companies(cube, config).join(counties, ["State", "County"], "left")
        .withColumn("County", F.when(F.col("kept"), F.col("County")).otherwise(fixed.OTHER))
        .drop("kept")
    )
    return _regroup_folded(relabelled) if distinct else regroup(relabelled)
