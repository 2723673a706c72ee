"""The refresh job: facts of the wanted slices into the stored cubes and catalogue."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from quotelens.config import MarketConfig
from quotelens.operators import months as month_ops
from quotelens.operators.catalog import state_index
from quotelens.operators.collapse import state_cube
from quotelens.operators.cube import monthly_cube
from quotelens.sources.facts import (
    Slice, check_slice, discover_jdbc, in_slices, read_dump, read_facts, read_jdbc, scan_dump, scan_slices,
)
from quotelens.sources.store import CubeStore, only_states, with_months

Facts = dict[str, DataFrame]


@dataclass
class RefreshResult:
    """What a run did: its slices, the states whose cube was written, states removed."""

    slices: list[Slice]
    states: list[str]
    removed: list[str]
    cube_rows: int


def _pairs(slices: DataFrame, state: str = "State_Name", month: str = "Year_Month") -> list[Slice]:
    # One row per state and month code.
    return sorted((r[0], r[1]) for r in slices.select(state, F.col(month).cast("string")).collect())


def choose_slices(
    discovered: Callable[[], DataFrame], store: CubeStore, config: MarketConfig, *,
    mode: str, state: str | Iterable[str] | None = None, months: Iterable[str] | None = None, active_only: bool = True,
) -> list[Slice]:
    """Slices of a run.

    `missing`: active and not stored yet. `all`: every active one. `state`: the
    given months of one or more states, or all their months when none are given.
    A dump is made of what is wanted, so its states need not be active.
    """
    states = [state] if isinstance(state, str) else sorted(set(state or []))
    if mode == "state":
        if not states:
            raise ValueError("mode 'state' needs a state")
        if months:
            return sorted({check_slice(s, m) for s in states for m in months})
        return _pairs(discovered().where(F.col("State_Name").isin(states)))
    active = month_ops.only_active(discovered(), config, "State_Name") if active_only else discovered()
    if states:
        active = active.where(F.col("State_Name").isin(states))
    if mode == "all":
        return _pairs(active)
    if mode == "missing":
        return _pairs(month_ops.missing_months(active, store.monthly()), "State", "YYYYMM")
    raise ValueError(f"unknown mode {mode!r}")


def refresh(
    facts: Facts, store: CubeStore, config: MarketConfig, slices: list[Slice], *,
    source: str = "parquet", dry_run: bool = False, prune: bool = False,
) -> RefreshResult:
    """Aggregate all slices in one job, store them, fold the states they touch.

    Only months that produced rows are replaced. Cubes and catalogue take effect
    together, when all their files are written. A dry run computes everything and
    writes nothing.
    """
    wanted = in_slices(slices)
    rate, car, driver = (facts[name].where(wanted) for name in ("rate", "car", "driver"))
    fresh = monthly_cube(rate, car, driver, config)
    touched = sorted({state for state, _ in slices})
    base = store.snapshot()
    stored = only_states(base, touched)
    if dry_run:
        # Read several times below, and not stored: kept by the executors, so that the facts are scanned once.
        fresh = fresh.persist(StorageLevel.DISK_ONLY)
        try:
            whole = month_ops.upsert_months(store.monthly(stored), fresh)
            rows = state_cube(whole, config).count()
        finally:
            fresh.unpersist()
        removed = store.prune_inactive(config, dry_run=True) if prune else []
        return RefreshResult(slices, touched, removed, rows)
    months = store.stage("monthly", fresh)
    whole = store.read("monthly", with_months(stored.monthly, months))
    states = store.stage("states", state_cube(whole, config))
    folded = store.read("states", states)
    rows = folded.count()
    store.publish(base, monthly=months, states=states, entries=state_index(folded, config), source=source)
    removed = store.prune_inactive(config) if prune else []
    return RefreshResult(slices, touched, removed, rows)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quotelens-refresh")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--facts", help="folder of the fact tables")
    source.add_argument("--jdbc", help="address of a database with the fact tables")
    parser.add_argument("--dump", action="store_true", help="the folder holds one file per table, state and month")
    parser.add_argument("--sample", type=float, help="percent of the database's pages that discovery looks at")
    parser.add_argument("--store", required=True, help="folder of the cubes and the catalogue")
    parser.add_argument("--mode", choices=["missing", "all", "state", "discover"], default="missing")
    parser.add_argument("--state", nargs="*")
    parser.add_argument("--months", nargs="*")
    parser.add_argument("--dry-run", action="store_true")
    args = parser.parse_args(argv)
    if args.dump and args.jdbc:
        parser.error("--dump goes with --facts")
    if args.sample is not None and not args.jdbc:
        parser.error("--sample goes with --jdbc")

    spark = SparkSession.builder.appName("quotelens-refresh").getOrCreate()
    config, store = MarketConfig(), CubeStore(spark, args.store)

    def discovered() -> DataFrame:
        if args.jdbc:
            return discover_jdbc(spark, args.jdbc, sample_percent=args.sample)
        return (scan_dump if args.dump else scan_slices)(spark, args.facts)

    if args.mode == "discover":
        # One row per state.
        for row in month_ops.state_months(discovered()).orderBy("State").collect():
            print(*row, sep="\t")
        return 0
    slices = choose_slices(
        discovered, store, config, mode=args.mode, state=args.state, months=args.months, active_only=not args.dump)
    if not slices:
        print("nothing to refresh")
        return 0
    if args.jdbc:
        facts, source_name = read_jdbc(spark, args.jdbc, slices), "database"
    elif args.dump:
        facts, source_name = read_dump(spark, args.facts), "dump"
    else:
        facts, source_name = read_facts(spark, args.facts), "parquet"
    # A dump holds some states only, so it says nothing about the others.
    result = refresh(
        facts, store, config, slices, source=source_name,
        dry_run=args.dry_run, prune=args.mode == "all" and not args.dump,
    )
    print(f"{len(result.slices)} slices, states {result.states}, {result.cube_rows} cube rows, removed {result.removed}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
