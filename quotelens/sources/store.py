"""Where cubes and the catalogue are kept, and how they change together."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quotelens.config import MarketConfig
from quotelens.operators.catalog import index_json, parse_index, upsert_index
from quotelens.operators.months import MONTH, with_provider
from quotelens.schemas import CATALOGUE_ENTRY, CUBE
from quotelens.sources import files
from quotelens.sources.facts import _listed, read_or_empty

#: state -> month -> the version whose files hold that month
Places = dict[str, dict[str, str]]

#: The version of months stored before there were versions.
UNVERSIONED = ""
CUBES = {"monthly": "monthly_cube", "states": "state_cube"}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class StoreConflict(RuntimeError):
    """Another job has published a state that this one changes; run it again on what is stored now."""


@dataclass(frozen=True)
class Snapshot:
    """What a manifest names: the files of each month of both cubes, and the catalogue's."""

    number: int = 0
    monthly: Places = field(default_factory=dict)
    states: Places = field(default_factory=dict)
    index: str = UNVERSIONED

    def of(self, cube: str) -> Places:
        return self.monthly if cube == "monthly" else self.states


class CubeStore:
    """A folder with the monthly cube, the folded state cube and the catalogue.

    Files are never changed. A write puts them under a new version, and a manifest says
    which version holds each month of a cube and the catalogue. Creating the next
    manifest is the single step by which a refresh takes effect, so a job that stops
    anywhere before it leaves the store as it was, and a reader sees one state of all
    three. Both cubes are partitioned by state and month, so a report reads only the
    months it asks for. The monthly cube is kept unfolded; what the state cube folds is
    always decided on all months.

    A folder from before there were manifests is read as it is and becomes part of the
    first one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    # --- reading -------------------------------------------------------------

    def snapshot(self) -> Snapshot:
        """The store as the last manifest names it."""
        found = [n for n in files.names(self.spark, f"{self.root}/manifest") if re.fullmatch(r"\d+\.json", n)]
        if not found:
            return Snapshot(0, *[self._places(f"{self.root}/{folder}", UNVERSIONED) for folder in CUBES.values()])
        last = max(found, key=lambda n: int(n.removesuffix(".json")))
        return Snapshot(**json.loads(files.read_text(self.spark, f"{self.root}/manifest/{last}")))

    def _places(self, folder: str, version: str) -> Places:
        listed, places = _listed(self.spark, folder), {}
        if listed is not None:
            pattern = "/State=([^/]+)/YYYYMM=([^/]+)/"
            # One row per state and month.
            parts = [F.regexp_extract("path", pattern, k).alias(name) for k, name in enumerate(MONTH, 1)]
            for state, month in listed.where(F.col("path").rlike(pattern)).select(*parts).distinct().collect():
                places.setdefault(state, {})[month] = version
        return places

    def read(self, cube: str, places: Places) -> DataFrame:
        """Rows of the given months of a cube, from the files of their versions."""
        old = [(s, int(m)) for s, months in places.items() for m, v in months.items() if v == UNVERSIONED]
        base = f"{self.root}/versions/{CUBES[cube]}"
        paths = [
            f"{base}/version={v}/State={s}/YYYYMM={m}"
            for s, months in sorted(places.items()) for m, v in sorted(months.items()) if v != UNVERSIONED
        ]
        parts = []
        if paths:
            schema = T.StructType([*CUBE.fields, T.StructField("version", T.StringType())])
            parts.append(self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*CUBE.fieldNames()))
        if old:
            rows = read_or_empty(self.spark, f"{self.root}/{CUBES[cube]}", CUBE).select(*CUBE.fieldNames())
            by_state: dict[str, list[int]] = {}
            for state, month in old:
                by_state.setdefault(state, []).append(month)
            live = F.lit(False)
            for state, months in sorted(by_state.items()):
                live = live | ((F.col("State") == state) & F.col("YYYYMM").isin(sorted(months)))
            parts.append(rows.where(live))
        if not parts:
            return self.spark.createDataFrame([], CUBE)
        return with_provider(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))

    def monthly(self, snapshot: Snapshot | None = None) -> DataFrame:
        return self.read("monthly", (snapshot or self.snapshot()).monthly)

    def states(self, snapshot: Snapshot | None = None) -> DataFrame:
        return self.read("states", (snapshot or self.snapshot()).states)

    def index_folder(self, snapshot: Snapshot | None = None) -> str:
        """The folder of the catalogue document."""
        version = (snapshot or self.snapshot()).index
        return f"{self.root}/index" if version == UNVERSIONED else f"{self.root}/versions/index/version={version}"

    def _index_text(self, snapshot: Snapshot | None) -> DataFrame | None:
        try:
            return self.spark.read.option("wholetext", True).text(self.index_folder(snapshot))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def index(self, snapshot: Snapshot | None = None) -> DataFrame:
        """Catalogue entries; none if there is no readable catalogue."""
        text = self._index_text(snapshot)
        return self.spark.createDataFrame([], CATALOGUE_ENTRY) if text is None else parse_index(text)

    def index_source(self, snapshot: Snapshot | None = None) -> str | None:
        """The source that the stored catalogue names."""
        text = self._index_text(snapshot)
        row = None if text is None else text.select(F.get_json_object("value", "$.source")).first()
        return row and row[0]

    # --- writing -------------------------------------------------------------

    def stage(self, cube: str, rows: DataFrame) -> Places:
        """Write rows as files of a new version that no manifest names yet; the months they hold.

        Each task writes what it has of a month: the cube is not shuffled to be written, and a month has no more files
        than there are tasks, of which adaptive execution leaves few for a small cube. Its shuffle files go as soon as
        it is written, so the next cube does not need room beside them.
        """
        version = uuid.uuid4().hex
        path = f"{self.root}/versions/{CUBES[cube]}/version={version}"
        with shuffles_dropped(self.spark):
            rows.select(*CUBE.fieldNames()).write.partitionBy(*MONTH).option("compression", "zstd").parquet(path)
            return self._places(path, version)

    def stage_index(self, entries: DataFrame, source: str) -> str:
        """Write the catalogue document as a new version."""
        version = uuid.uuid4().hex
        utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
        now = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
        document = index_json(entries, now, source).coalesce(1)
        document.write.text(f"{self.root}/versions/index/version={version}")
        return version

    def publish(
        self, base: Snapshot, *, monthly: Places | None = None, states: Places | None = None,
        entries: DataFrame | None = None, source: str = "unknown", removed: Iterable[str] = (),
    ) -> Snapshot:
        """Make staged files take effect, all in one step.

        `monthly` replaces single months, `states` all months of its states, `entries`
        the catalogue entries of their states. If another job has published since
        `base`, its states are kept; if it changed one of the same states, that is a
        conflict and nothing is published.
        """
        monthly, states, removed = monthly or {}, states or {}, set(removed)
        changed = {*monthly, *states, *removed}
        while True:
            now = self.snapshot()
            for cube in CUBES:
                if any(now.of(cube).get(s) != base.of(cube).get(s) for s in changed):
                    raise StoreConflict(f"published meanwhile: one of {sorted(changed)}")
            index = now.index
            if entries is not None or removed:
                kept = self.index(now)
                whole = kept if entries is None else upsert_index(kept, entries)
                if removed:
                    whole = whole.where(~F.col("state").isin(sorted(removed)))
                index = self.stage_index(whole, source)

            def but(places: Places) -> Places:
                return {s: months for s, months in places.items() if s not in removed}

            following = Snapshot(
                now.number + 1,
                but(with_months(now.monthly, monthly)),
                but(now.states | states), index,
            )
            text = json.dumps({**following.__dict__}, sort_keys=True)
            if files.create_text(self.spark, f"{self.root}/manifest/{following.number:09d}.json", text):
                return following

    def prune_inactive(self, config: MarketConfig, *, dry_run: bool = False) -> list[str]:
        """Remove the cubes and catalogue entries of inactive states; returns those states.

        Their files stay until `vacuum`, for those who still read an older state.
        """
        base = self.snapshot()
        listed = [r.state for r in self.index(base).select("state").collect()]
        removed = sorted({*base.monthly, *base.states, *listed} - set(config.active_states))
        if removed and not dry_run:
            self.publish(base, removed=removed, source=self.index_source(base) or "unknown")
        return removed

    def vacuum(self, keep: int = 2) -> int:
        """Delete versions that none of the last `keep` manifests names, and older manifests; how many versions went.

        Files staged by a job that has not published yet are among them, so run it alone.
        """
        found = sorted(n for n in files.names(self.spark, f"{self.root}/manifest") if re.fullmatch(r"\d+\.json", n))
        kept = [json.loads(files.read_text(self.spark, f"{self.root}/manifest/{n}")) for n in found[-keep:]]
        used = {m["index"] for m in kept}
        used |= {v for m in kept for cube in CUBES for months in m[cube].values() for v in months.values()}
        gone = 0
        for folder in [*CUBES.values(), "index"] if kept else []:
            for name in files.names(self.spark, f"{self.root}/versions/{folder}"):
                if name.removeprefix("version=") not in used:
                    files.delete(self.spark, f"{self.root}/versions/{folder}/{name}")
                    gone += 1
        for name in found[:-keep]:
            files.delete(self.spark, f"{self.root}/manifest/{name}")
        return gone

    def register_view(self, state: str, name: str = "state_cube") -> DataFrame:
        """Make one state's cube available to SQL under a name."""
        cube = self.states().where(F.col("State") == state)
        cube.createOrReplaceTempView(name)
        return cube


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of queries run in this block are deleted as each ends.

    Spark else keeps them until the JVM has collected the query's plan.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def only_states(snapshot: Snapshot, states: Iterable[str]) -> Snapshot:
    """A snapshot of some states alone."""
    wanted = set(states)
    return replace(
        snapshot, monthly={s: m for s, m in snapshot.monthly.items() if s in wanted},
        states={s: m for s, m in snapshot.states.items() if s in wanted})


def with_months(places: Places, fresh: Places) -> Places:
    """Places in which the fresh months replace those of the same state and month."""
    return places | {s: places.get(s, {}) | months for s, months in fresh.items()}
