"""Per-state settings that the operators take as an argument."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from quotelens import fixed_values as fixed


@dataclass(frozen=True)
class MarketConfig:
    """Which companies a state names, compares with, represents and keeps."""

    company_names: Mapping[str, Mapping[int, str]] = field(default_factory=lambda: fixed.COMPANY_NAMES)
    exhaustive_states: Sequence[str] = tuple(fixed.EXHAUSTIVE_STATES)
    comparison_company: Mapping[str, str] = field(default_factory=lambda: fixed.COMPARISON_COMPANY)
    our_companies: Mapping[str, Sequence[str]] = field(default_factory=lambda: fixed.OUR_COMPANIES)
    active_states: Sequence[str] = tuple(fixed.ACTIVE_STATES)
    credit_states: Sequence[str] = tuple(fixed.CREDIT_STATES)
    house_company: str = fixed.HOUSE_COMPANY
    top_counties: int = fixed.TOP_COUNTIES

    def kept_companies(self, state: Column) -> Column:
        """How many unmapped companies a state keeps under their own id."""
        mapped = [s for s in self.company_names if s not in self.exhaustive_states]
        return (
            F.when(state.isin(list(self.exhaustive_states)), fixed.TOP_COMPANIES_EXHAUSTIVE)
            .when(state.isin(mapped), fixed.TOP_COMPANIES_MAPPED)
            .otherwise(fixed.TOP_COMPANIES_UNMAPPED)
        )

    def comparison_for(self, state: Column) -> Column:
        """The state's comparison company, null where it has none."""
        name = F.lit(None).cast("string")
        for code, company in self.comparison_company.items():
            name = F.when(state == code, company).otherwise(name)
        return name

    def is_ours(self, state: Column, company: Column) -> Column:
        """Whether the company is one of those represented in the state."""
        ours = F.lit(False)
        for code, companies in self.our_companies.items():
            ours = ours | ((state == code) & company.isin(list(companies)))
        return F.coalesce(ours, F.lit(False))

    def ours_for(self, state: Column) -> Column:
        """The represented companies of a state as an array, empty where none."""
        names = F.array().cast("array<string>")
        for code, companies in self.our_companies.items():
            names = F.when(state == code, F.array(*[F.lit(c) for c in companies])).otherwise(names)
        return names
