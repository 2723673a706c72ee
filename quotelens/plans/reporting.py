"""Reports of one state from the store, and their export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from quotelens.config import MarketConfig
from quotelens.operators.catalog import displayable
from quotelens.operators.report import ReportFilters, company_report, visible_columns
from quotelens.sources.store import CubeStore


def report_states(store: CubeStore) -> list[str]:
    """States a report can be shown for, in order."""
    return [r.state for r in displayable(store.index()).orderBy("state").collect()]


def state_report(
    store: CubeStore, state: str, config: MarketConfig,
    filters: ReportFilters = ReportFilters(), discounts: Mapping[str, float] | None = None,
) -> DataFrame:
    """The report of one state with the columns that apply to it."""
    entry = store.index().where(F.col("state") == state).first()
    if entry is None:
        raise ValueError(f"no catalogue entry for {state!r}")
    cube = store.states().where(F.col("State") == state)
    companies = store.index().where(F.col("state") == state).select(
        F.col("state").alias("State"), F.explode("companies").alias("CompanyName"))
    report = company_report(cube, config, filters, discounts, companies)
    return report.select(*visible_columns(entry.companies, entry.comparison_company, config.house_company))


def export_csv(report: DataFrame, path: str) -> None:
    """Write a report with a header row; a report is a few dozen rows, in one file."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
