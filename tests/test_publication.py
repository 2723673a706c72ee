"""A store changes in one step: jobs that stop anywhere, jobs side by side, older layouts, providers."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quotelens.functions import bins
from quotelens.operators import catalog
from quotelens.operators.collapse import state_cube
from quotelens.operators.cube import monthly_cube
from quotelens.operators.report import ReportFilters, slice_cube
from quotelens.plans import refresh as job
from quotelens.schemas import CUBE
from quotelens.sources import facts as sources
from quotelens.sources import files
from quotelens.sources.store import CubeStore, StoreConflict
from tests import frames
from verification.mapping import CONFIG, mapped_facts
from verification.registry import QUERIES

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    made = str(tmp_path_factory.mktemp("facts"))
    sources.write_facts(mapped_facts(spark, SF), made)
    return made


@pytest.fixture(scope="module")
def facts(spark, root):
    return sources.read_facts(spark, root)


def all_of(store):
    return [sorted(map(str, f.collect())) for f in (store.monthly(), store.states(), store.index())]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["stage:1", "stage:2", "stage_index:1", "create_text:1"])
@pytest.mark.parametrize("after", [False, True])
def test_a_job_that_stops_leaves_the_old_state(spark, facts, tmp_path, monkeypatch, step, after):
    store = CubeStore(spark, str(tmp_path))
    job.refresh(facts, store, CONFIG, [("IL", "202501"), ("AZ", "202501")])
    before = all_of(store)
    name, which = step.split(":")
    owner = files if name == "create_text" else CubeStore
    original, calls = getattr(owner, name), []

    def stopping(*args, **kwargs):
        calls.append(1)
        if len(calls) == int(which) and not after:
            raise Stopped
        made = original(*args, **kwargs)
        if len(calls) == int(which):
            raise Stopped
        return made

    monkeypatch.setattr(owner, name, stopping)
    with pytest.raises(Stopped):
        job.refresh(facts, store, CONFIG, [("IL", "202502"), ("TX", "202502")])
    monkeypatch.undo()
    published = name == "create_text" and after
    assert (all_of(CubeStore(spark, str(tmp_path))) == before) is not published
    job.refresh(facts, store, CONFIG, [("IL", "202502"), ("TX", "202502")])
    whole = CubeStore(spark, str(tmp_path) + "-whole")
    job.refresh(facts, whole, CONFIG, [("IL", "202501"), ("AZ", "202501"), ("IL", "202502"), ("TX", "202502")])
    assert all_of(store) == all_of(whole)


KILLED = """
import os, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from quotelens.plans import refresh as job
from quotelens.sources import facts as sources
from quotelens.sources.store import CubeStore
from verification.mapping import CONFIG

spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
CubeStore.stage_index = lambda *a, **k: os._exit(9)
job.refresh(sources.read_facts(spark, sys.argv[2]), CubeStore(spark, sys.argv[3]), CONFIG, [("IL", "202502")])
"""


def test_a_killed_driver_leaves_the_old_state(spark, facts, root, tmp_path):
    store = CubeStore(spark, str(tmp_path / "store"))
    job.refresh(facts, store, CONFIG, [("IL", "202501")])
    before = all_of(store)
    done = subprocess.run([sys.executable, "-c", KILLED, str(REPO), root, str(tmp_path / "store")], env=os.environ, capture_output=True)
    assert done.returncode == 9, done.stderr[-2000:]
    assert len(list((tmp_path / "store/versions/state_cube").iterdir())) == 2
    assert all_of(store) == before
    assert store.vacuum() == 2 and all_of(store) == before


def test_two_jobs_side_by_side(spark, facts, tmp_path):
    """Other states of a job that was first are kept; the same state is a conflict."""
    store = CubeStore(spark, str(tmp_path))
    job.refresh(facts, store, CONFIG, [("IL", "202501")])
    base = store.snapshot()
    mine = {name: table.where(sources.in_slices([("AZ", "202501")])) for name, table in facts.items()}
    months = store.stage("monthly", monthly_cube(mine["rate"], mine["car"], mine["driver"], CONFIG))
    states = store.stage("states", state_cube(store.read("monthly", months), CONFIG))
    job.refresh(facts, store, CONFIG, [("IL", "202502"), ("TX", "202501")])
    entries = catalog.state_index(store.read("states", states), CONFIG)
    store.publish(base, monthly=months, states=states, entries=entries, source="parquet")
    whole = CubeStore(spark, str(tmp_path) + "-whole")
    job.refresh(facts, whole, CONFIG, [("IL", "202501"), ("IL", "202502"), ("TX", "202501"), ("AZ", "202501")])
    assert all_of(store) == all_of(whole)
    with pytest.raises(StoreConflict):
        store.publish(base, monthly=months, states=states, entries=entries, source="parquet")
    assert all_of(store) == all_of(whole)


def test_vacuum_keeps_what_is_named(spark, facts, tmp_path):
    store = CubeStore(spark, str(tmp_path))
    for month in ("202501", "202502", "202501", "202503"):
        job.refresh(facts, store, CONFIG, [("IL", month)])
    now, older = all_of(store), store.snapshot()
    job.refresh(facts, store, CONFIG, [("IL", "202503")])
    assert store.vacuum(keep=2) > 0
    assert all_of(store) == now and store.monthly(older).count() == store.monthly().count()
    assert store.vacuum(keep=1) > 0 and all_of(store) == now
    assert CubeStore(spark, str(tmp_path / "none")).vacuum() == 0


def test_files_are_created_once(spark, tmp_path):
    assert files.create_text(spark, f"{tmp_path}/a/1.json", "é")
    assert not files.create_text(spark, f"{tmp_path}/a/1.json", "other")
    assert files.read_text(spark, f"file://{tmp_path}/a/1.json") == "é"
    assert files.names(spark, f"{tmp_path}/a") == ["1.json"] and files.names(spark, f"{tmp_path}/b") == []


def test_a_store_from_before_versions_and_providers(spark, facts, tmp_path):
    """Months of the older layout without the column are read with the default provider and live on beside new ones."""
    old = monthly_cube(*(facts[n].where("State_Name = 'IL' AND Year_Month = '202501'") for n in ("rate", "car", "driver")), CONFIG)
    old = old.where("RateSource = 'ITC'").drop("RateSource")
    for folder, rows in (("monthly_cube", old), ("state_cube", old.withColumn("County", F.lit("Other")))):
        rows.write.partitionBy("State", "YYYYMM").parquet(f"{tmp_path}/{folder}")
    store = CubeStore(spark, str(tmp_path))
    assert [f.name for f in store.monthly().schema] == CUBE.fieldNames()
    assert {r.RateSource for r in store.monthly().select("RateSource").distinct().collect()} == {"ITC"}
    assert store.monthly().count() == old.count() > 0
    job.refresh(facts, store, CONFIG, [("IL", "202502"), ("AZ", "202502")])
    assert store.monthly().where("YYYYMM = 202501").count() == old.count()
    assert {r.RateSource for r in store.monthly().where("YYYYMM = 202502").select("RateSource").distinct().collect()} == {"ITC", "EZ Lynx"}
    counts = {p: slice_cube(store.states(), ReportFilters(provider=p)).agg(F.sum("Quotes")).first()[0] for p in ("ITC", "EZ Lynx", "Any")}
    assert counts["EZ Lynx"] > 0 and counts["ITC"] + counts["EZ Lynx"] == counts["Any"]
    job.refresh(facts, store, CONFIG, [("IL", "202501")])
    assert store.snapshot().monthly["IL"]["202501"] != "" and "EZ Lynx" in {
        r.RateSource for r in store.monthly().where("YYYYMM = 202501").select("RateSource").distinct().collect()}


def test_the_earliest_quote_decides_the_provider(spark):
    rates = [
        {"RateIteration": 2, "Rate_Source": "EZ Lynx"}, {"RateIteration": 1, "Rate_Source": None},
        {"PolicyLinkID": 2, "Rate_Source": " EZ Lynx "}, {"PolicyLinkID": 3, "Rate_Source": " "},
    ]
    cube = monthly_cube(frames.rate(spark, *rates), frames.car(spark, {}), frames.driver(spark, {}), CONFIG)
    assert {(r.RateSource, r.Quotes) for r in cube.collect()} == {("ITC", 2), ("EZ Lynx", 1)}
    named = spark.createDataFrame([("x",), (None,), ("",)], "s string").select(bins.provider(F.col("s")).alias("p"))
    assert [r.p for r in named.collect()] == ["x", "ITC", "ITC"]


def test_facts_without_the_provider_column(spark, tmp_path):
    frames.rate(spark, {}).drop("Rate_Source").write.partitionBy("State_Name", "Year_Month").parquet(str(tmp_path / "rate"))
    assert sources.read_facts(spark, str(tmp_path))["rate"].first().Rate_Source is None


@pytest.mark.parametrize("name", ["rate", "car", "driver", "violation"])
def test_stored_scans_prune_by_folder(spark, name):
    plan = QUERIES[f"scan_stored_{name}"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters:"):].split("]")[0]
    assert "State_Name" in filters and "Year_Month" in filters and "PushedFilters: []" in plan


def test_reads_open_only_the_months_asked_for(spark, facts, tmp_path):
    store = CubeStore(spark, str(tmp_path))
    job.refresh(facts, store, CONFIG, [("IL", "202501"), ("IL", "202502"), ("AZ", "202501")])
    one = store.states().where("State = 'IL' AND YYYYMM = 202502")
    assert one.count() > 0 and "PartitionFilters: [isnotnull(State" in one._jdf.queryExecution().executedPlan().toString()
    used = {r[0].split("/State=")[1].split("/part")[0] for r in one.select(F.input_file_name()).distinct().collect()}
    assert used == {"IL/YYYYMM=202502"}
